"""Exponentially weighted mean of the rows before the current one, for groups of any size.

A step is y -> a * y + b, and steps combine: two in a row are again such a step. Rows are cut into
blocks, solved in closed form inside a block, and each block is reduced to its (a, b). The blocks
of a group are combined in runs of ``FAN``, these again, and so on until one run is left; the state
then goes down the same levels. Nothing is forgotten, and no task holds more than a run of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlake.operators.ordered import running
from marlake.session import stage

BLOCK = 512
FAN = 512
# Largest exponent that the closed form meets in a block, and the smallest log weight that a gap leaves the past.
EXPONENT = 300.0
FLOOR = -350.0


def block_length(alpha: float) -> int:
    """Rows per block, few enough that the weights inside a block stay within a double."""
    if not 0.0 < alpha < 1.0:
        raise ValueError(f"alpha must lie between 0 and 1, not {alpha}")
    return max(1, min(BLOCK, int(EXPONENT / -math.log(1.0 - alpha))))


def prior_ewma(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    alpha: float = 0.3,
    through: str | None = None,
) -> DataFrame:
    """Add ``out``: the mean over earlier rows of the group, newest rows weighing most.

    ``through`` names a second output, the mean with the current row in it.

    Recursion y = (w*y + alpha*x) / (w + alpha) with w = (1 - alpha) ** (rows since the last
    value); missing values leave y as it is, the first value starts it.
    """
    block = block_length(alpha)
    decay = math.log(1.0 - alpha)
    cols = df.columns

    seen = F.col(value).isNotNull()
    placed = running(df, groups, order, sums={"_pos": F.lit(1)}, then_last={"_last": F.when(seen, F.col("_pos"))})

    x = F.col(value).cast("double")
    weight = F.exp(F.lit(decay) * (F.col("_pos") - F.col("_last")))
    keep = weight / (weight + F.lit(alpha))
    first = F.col("_last").isNull()
    points = placed.withColumns(
        {
            "_block": F.floor(F.col("_pos") / block),
            "_ln": F.when(seen & ~first, F.greatest(F.log(keep), F.lit(FLOOR))).otherwise(F.lit(0.0)),
            "_gain": F.when(~seen, F.lit(0.0)).when(first, F.lit(1.0)).otherwise(1.0 - keep),
        }
    )
    w = Window.partitionBy(*groups, "_block").orderBy("_pos")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    points = points.withColumn("_p", F.sum("_ln").over(upto))
    points = points.withColumn("_c", F.when(seen, F.col("_gain") * x * F.exp(-F.col("_p"))).otherwise(F.lit(0.0)))
    points = points.withColumns({"_s": F.sum("_c").over(upto), "_s0": F.coalesce(F.sum("_c").over(before), F.lit(0.0))})
    points = stage(points.drop("_c", "_gain"), "points")

    whole = points.groupBy(*groups, "_block").agg(F.max_by("_p", "_pos").alias("_p"), F.max_by("_s", "_pos").alias("_s"))
    blocks = stage(whole.select(*groups, "_block", F.exp("_p").alias("_a"), (F.exp("_p") * F.col("_s")).alias("_b")), "blocks")
    joined = with_starts(points, block_starts(blocks, groups), groups)
    start = F.coalesce("_start", F.lit(0.0))
    prior = F.when(F.col("_last").isNotNull(), F.exp(F.col("_p") - F.col("_ln")) * (start + F.col("_s0")))
    extra = [F.when(seen, F.exp("_p") * (start + F.col("_s"))).otherwise(prior).alias(through)] if through else []
    return joined.select(*cols, prior.alias(out), *extra)


def with_starts(rows: DataFrame, starts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``rows`` with the ``_start`` of their block; a null group is a group like any other."""
    named = starts.select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_block").alias("_g_block"), "_start")
    same = F.col("_block") == F.col("_g_block")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return rows.join(named, same, "left").drop(*[f"_g_{g}" for g in groups], "_g_block")


def block_starts(blocks: DataFrame, groups: Sequence[str], fan: int = FAN) -> DataFrame:
    """State before each block (groups, _block, _start), from the blocks' steps (_a, _b)."""
    last = blocks.agg(F.max("_block")).first()[0] or 0
    runs = blocks.groupBy(*groups, F.floor(F.col("_block") / fan).alias("_run")).agg(
        F.array_sort(F.collect_list(F.struct("_block", "_a", "_b"))).alias("_steps")
    )
    runs = runs.withColumn("_fold", folded(F.col("_steps")))
    if last >= fan:
        runs = stage(runs, "runs")
        upper = runs.select(*groups, F.col("_run").alias("_block"), F.col("_fold.a").alias("_a"), F.col("_fold.b").alias("_b"))
        runs = with_starts(runs.withColumn("_block", F.col("_run")), block_starts(upper, groups, fan), groups).drop("_block")
    else:
        runs = runs.withColumn("_start", F.lit(0.0))
    each = runs.select(*groups, "_start", F.explode(F.arrays_zip(F.col("_steps"), F.col("_fold.before").alias("before"))).alias("e"))
    step, before = F.col("e").getField("_steps"), F.col("e").getField("before")
    return each.select(*groups, step["_block"].alias("_block"), (before["a"] * F.col("_start") + before["b"]).alias("_start"))


def folded(steps: Column) -> Column:
    """All steps as one (a, b), and for each the step that those before it make."""
    none = F.array().cast("array<struct<a: double, b: double>>")
    return F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), none.alias("before")),
        lambda s, x: F.struct(
            (x["_a"] * s["a"]).alias("a"),
            (x["_a"] * s["b"] + x["_b"]).alias("b"),
            F.array_append(s["before"], F.struct(s["a"].alias("a"), s["b"].alias("b"))).alias("before"),
        ),
    )
