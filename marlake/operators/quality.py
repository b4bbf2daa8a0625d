"""Data checks. Failures are rows of the result; the caller decides what to do about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _result(df: DataFrame, table: str, column: str, check: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
        F.col("checked").cast("bigint").alias("checked"),
    )


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Null counts of all columns in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("checked"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(
        f"'{table}' as table_name",
        f"stack({len(columns)}, {pairs}) as (column_name, failures)",
        "'not_null' as check_name",
        "checked",
    ).select("table_name", "column_name", "check_name", "failures", "checked")


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once; nulls are not compared."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counts = per_value.agg(F.count_if(F.col("n") > 1).alias("failures"), F.sum("n").alias("checked"))
    return _result(counts.withColumn("checked", F.coalesce("checked", F.lit(0))), table, column, "unique")


def accepted_values(df: DataFrame, table: str, column: str, values: list) -> DataFrame:
    """Rows whose value is outside the list; null passes."""
    counts = df.agg(
        F.count_if(~F.col(column).isin(values)).alias("failures"), F.count(F.lit(1)).alias("checked")
    )
    return _result(counts, table, column, "accepted_values")


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose value has no parent; null passes.

    Child rows are counted per value before the join, so a hot value is one row in the join.
    """
    per_value = child.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias("v")).distinct().withColumn("known", F.lit(True))
    counts = per_value.join(known, "v", "left").agg(
        F.sum(F.when(F.col("v").isNotNull() & F.col("known").isNull(), F.col("n"))).alias("failures"),
        F.sum("n").alias("checked"),
    )
    return _result(counts.withColumn("checked", F.coalesce("checked", F.lit(0))), table, column, "relationships")


def all_relationships(frames: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Like :func:`relationships` for many (table, column, parent table, parent column), reading every table once.

    Each row gives its value to every check it takes part in, as child or as parent; values are counted
    per check before and after one shuffle, and a second, tiny one adds up the checks.
    """
    roles: dict[str, list[Column]] = {}
    for k, (table, column, parent, parent_column) in enumerate(relations):
        for name, col, child in ((table, column, 1), (parent, parent_column, 0)):
            value = F.col(col).cast("string").alias("v")
            roles.setdefault(name, []).append(F.struct(F.lit(k).alias("k"), value, F.lit(child).alias("child"), F.lit(1 - child).alias("parent")))
    each = [frames[name].select(F.explode(F.array(*own)).alias("r")).select("r.*") for name, own in roles.items()]
    per_value = reduce(lambda a, b: a.unionByName(b), each).groupBy("k", "v").agg(F.sum("child").alias("n"), F.max("parent").alias("known"))
    lost = F.when(F.col("v").isNotNull() & (F.col("known") == 0), F.col("n")).otherwise(0)
    none = frames[relations[0][0]].sparkSession.range(len(relations)).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("lost"), F.lit(0).alias("n"))
    sums = per_value.select("k", lost.alias("lost"), "n").unionByName(none).groupBy("k").agg(F.sum("lost").alias("failures"), F.sum("n").alias("checked"))
    of = lambda i: F.element_at(F.array(*[F.lit(r[i]) for r in relations]), F.col("k") + 1)
    return sums.select(
        of(0).alias("table_name"), of(1).alias("column_name"), F.lit("relationships").alias("check_name"), F.col("failures").cast("bigint"), F.col("checked").cast("bigint")
    )


def report(checks: list[DataFrame]) -> DataFrame:
    """All checks in one frame, run as one job."""
    return reduce(lambda a, b: a.unionByName(b), checks)
