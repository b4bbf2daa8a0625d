"""Pick one row per key, and the merge of a batch into an existing deduplicated table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Row that sorts first within each key.

    Written as ``row_number() = 1`` because Spark then keeps only the best row per key inside
    each map task, before the shuffle. A key that holds a third of the table costs one row per
    task on the wire.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    version: str = "batch_id",
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Row of the latest ``version`` per key; nulls come last, ties fall to a total order.

    Versions compare as text: ``backfill-`` < ``historical_`` < ``live-``.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c != version]
    order = [F.col(version).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    return first_per_key(df, keys, order)


def merge_latest(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    version: str = "batch_id",
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Existing rows and a new batch brought back to one row per key."""
    both = existing.unionByName(incoming, allowMissingColumns=True)
    return latest_per_key(both, keys, version, tiebreak)


def join_keys(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join on keys where null equals null, as it does in a grouping."""
    named = other.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return df.join(named, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), how)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row; the key columns alone cross the wire for it."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")


def differences(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: row counts of both frames and of the rows only one of them has (multiset).

    keys -- columns that the rows of ``right`` are dealt out by, as those of a deduplicated frame are
    by its keys: ``left`` is dealt out alike, and rows are compared where they lie. Equal rows have
    equal keys, so the outcome does not depend on it.
    """
    cols = left.columns
    left = left.repartition(*keys) if keys else left
    tagged = left.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_row = tagged.groupBy(*cols).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    return per_row.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_l") - F.col("_r"), F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("_r") - F.col("_l"), F.lit(0))), F.lit(0)).alias("only_right"),
    )
