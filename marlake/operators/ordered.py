"""Running values over an order, for groups of any size.

A plain window sorts a whole group inside one task. That is what runs for groups of up to
``CHUNK_ROWS`` rows. A larger group is cut into chunks of its order: bounds come from a sample of
its order keys (drawn by hash, so the same on every run), each chunk is summed up, the running
value of the chunk sums enters each chunk as one extra leading row, and the window runs inside
(group, chunk). Order keys are compared as a whole, so rows that share a time or a score are
split as well. The rows themselves are never written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlake.session import stage

CHUNK = "_chunk"
# Rows that one task sorts at most, about; chunks of a group at most; sampled keys per chunk.
CHUNK_ROWS = 1_000_000
MOST_CHUNKS = 1 << 16
SAMPLES = 16
# A small table is sent to all tasks up to that many values in all; else the join shuffles.
SMALL_VALUES = 1_000_000


def running(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column | str] | None = None,
    last: Mapping[str, Column | str] | None = None,
    totals: Mapping[str, str] | None = None,
    then_last: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Add values taken over the rows *before* the current one within its group.

    sums      -- name -> value whose exclusive running sum is wanted (0 for the first row)
    last      -- name -> value whose last non-null earlier occurrence is wanted
    totals    -- name -> name of an entry of ``sums``; adds the sum over the whole group
    then_last -- like ``last``, over values that may use the names of ``sums`` and ``last``

    ``order`` must be unique within a group. One narrow aggregate finds the groups over
    ``CHUNK_ROWS`` first; ``df`` is read again for the values, so what is expensive to compute
    should be a written table.
    """
    sums, last, totals = dict(sums or {}), dict(last or {}), dict(totals or {})
    bounds = chunk_bounds(df, groups, order)
    if bounds is None:
        out = plain(df, groups, order, sums, last, totals)
        return plain(out, groups, order, {}, dict(then_last), {}) if then_last else out
    out = in_chunks(with_chunks(df, bounds, groups, order), groups, order, sums, last, totals)
    if then_last:
        out = in_chunks(out, groups, order, {}, dict(then_last), {})
    return out.drop(CHUNK)


def chunk_bounds(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """Chunk borders (``groups``, ``_bounds``: ascending order keys) of the groups over ``CHUNK_ROWS``; None without any."""
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CHUNK_ROWS)
    if sizes.isEmpty():
        return None
    chunks = F.least(F.ceil(F.col("_n") / CHUNK_ROWS), F.lit(MOST_CHUNKS))
    large = stage(sizes.withColumn("_every", F.greatest(F.floor(F.col("_n") / (chunks * SAMPLES)), F.lit(1))), "large-groups")
    key = F.struct(*order)
    keys = joined_by_group(df.select(*groups, key.alias("_key")), small(large.select(*groups, "_every")), groups, "inner")
    drawn = keys.where(F.pmod(F.xxhash64("_key", F.lit(11)), F.col("_every")) == 0)
    drawn = drawn.groupBy(*groups).agg(F.array_sort(F.collect_list("_key")).alias("_keys"))
    picked = F.filter("_keys", lambda _, i: (i % SAMPLES == 0) & (i > 0))
    return stage(drawn.select(*groups, picked.alias("_bounds")), "chunk-bounds")


def with_chunks(df: DataFrame, bounds: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with the number of each row's chunk: the borders of its group that its key has reached, by binary search."""
    most = bounds.agg(F.sum(F.size("_bounds"))).first()[0] or 0
    found = joined_by_group(df, F.broadcast(bounds) if most <= SMALL_VALUES else bounds, groups, "left")
    key, borders = F.struct(*order), F.col("_bounds")
    n = F.coalesce(F.size(borders), F.lit(0))
    found = found.withColumns({"_key": key, "_to": F.greatest(n, F.lit(0))})
    whole = F.struct(F.lit(0).alias("low"), F.col("_to").alias("high"))

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        reached = F.get(borders, middle) <= F.col("_key")
        return (
            F.when(s["low"] >= s["high"], s)
            .when(reached, F.struct((middle + 1).alias("low"), s["high"].alias("high")))
            .otherwise(F.struct(s["low"].alias("low"), middle.alias("high")))
        )

    steps = F.sequence(F.lit(1), F.lit(MOST_CHUNKS.bit_length() + 1))
    place = F.when(F.col("_to") > 0, F.aggregate(steps, whole, step, lambda s: s["low"])).otherwise(F.lit(0))
    return found.withColumn(CHUNK, place).drop("_bounds", "_key", "_to")


def joined_by_group(rows: DataFrame, per_group: DataFrame, groups: Sequence[str], how: str) -> DataFrame:
    """Join a table of one row per group; a null group is a group like any other."""
    if not groups:  # one group, one row
        value = per_group.columns[0]
        return rows.withColumn(value, per_group.select(value).scalar())
    named = per_group.withColumnsRenamed({g: f"_g_{g}" for g in groups})
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups])
    return rows.join(named, same, how).drop(*[f"_g_{g}" for g in groups])


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL_VALUES + 1).count() <= SMALL_VALUES else df


def plain(df, groups, order, sums, last, totals) -> DataFrame:
    """The values by windows over whole groups."""
    w = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        *df.columns,
        *[F.coalesce(F.sum(_col(v)).over(before), F.lit(0)).alias(n) for n, v in sums.items()],
        *[F.last(_col(v), ignorenulls=True).over(before).alias(n) for n, v in last.items()],
        *[F.sum(_col(sums[src])).over(whole).alias(n) for n, src in totals.items()],
    )


def in_chunks(rows: DataFrame, groups, order, sums, last, totals) -> DataFrame:
    """The values over (group, chunk), with one leading row that carries what the earlier chunks hold."""
    out_cols = [c for c in rows.columns if c != CHUNK]
    rows = rows.withColumns({f"_in_{n}": _col(v) for n, v in {**sums, **last}.items()})
    order_key = F.struct(*[F.col(c) for c in order])
    per_chunk = rows.groupBy(*groups, CHUNK).agg(
        *[F.sum(f"_in_{n}").alias(f"_in_{n}") for n in sums],
        *[F.max_by(F.col(f"_in_{n}"), F.when(F.col(f"_in_{n}").isNotNull(), order_key)).alias(f"_in_{n}") for n in last],
    )
    across = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(CHUNK)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = per_chunk.select(
        *groups,
        CHUNK,
        *[F.coalesce(F.sum(f"_in_{n}").over(before), F.lit(0)).alias(f"_in_{n}") for n in sums],
        *[F.last(f"_in_{n}", ignorenulls=True).over(before).alias(f"_in_{n}") for n in last],
        *[F.sum(f"_in_{src}").over(whole).alias(f"_tot_{n}") for n, src in totals.items()],
        F.lit(0).alias("_own"),
    )
    both = rows.withColumn("_own", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    inside = Window.partitionBy(*groups, CHUNK).orderBy("_own", *order)
    prior = inside.rowsBetween(Window.unboundedPreceding, -1)
    full = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return both.select(
        *out_cols,
        CHUNK,
        "_own",
        *[F.sum(f"_in_{n}").over(prior).alias(n) for n in sums],
        *[F.last(f"_in_{n}", ignorenulls=True).over(prior).alias(n) for n in last],
        *[F.first(f"_tot_{n}").over(full).alias(n) for n in totals],
    ).where("_own = 1").drop("_own")


def _col(v) -> Column:
    return v if isinstance(v, Column) else F.col(v)
