"""Leakage-free rates: what was known about a group before the current row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import mean_of, ratio, shrink
from marlake.operators.ordered import running


def overall_mean(df: DataFrame, value: str):
    """Mean over all rows as a scalar subquery."""
    return df.agg(mean_of(F.col(value).cast("double")).alias("m")).scalar()


def prior_mean(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], means: dict[str, str], count: str | None = None
) -> DataFrame:
    """Mean of each value over the earlier rows of the group; null before the first value.

    means -- output name -> value column; ``count`` names the number of earlier values of the
    first entry.
    """
    sums = {}
    for name, value in means.items():
        sums[f"_s_{name}"] = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
        sums[f"_n_{name}"] = F.col(value).isNotNull().cast("long")
    out = running(df, groups, order, sums=sums)
    first = next(iter(means))
    extra = [F.col(f"_n_{first}").alias(count)] if count else []
    return out.select(
        *df.columns, *[ratio(f"_s_{n}", f"_n_{n}").alias(n) for n in means], *extra
    )


def global_prior(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Mean over all earlier rows; the overall mean where there are none."""
    base = overall_mean(df, value)
    return prior_mean(df, [], order, {out: value}).withColumn(out, F.coalesce(F.col(out), base))


def expanding_prior(
    df: DataFrame, group: str, order: Sequence[str], value: str, out: str, fallback: str
) -> DataFrame:
    """Group's prior mean; rows without group or history take ``fallback``, a global prior."""
    found = prior_mean(df, [group], order, {out: value})
    known = F.when(F.col(group).isNotNull(), F.col(out))
    return found.withColumn(out, F.coalesce(known, F.col(fallback)))


def shrunken_prior(
    df: DataFrame, group: str, order: Sequence[str], value: str, out: str, fallback: str, weight: float = 15.0
) -> DataFrame:
    """Group's prior mean pulled towards the global prior by ``weight`` rows."""
    found = prior_mean(df, [group], order, {"_mean": value}, count="_count")
    known = F.col(group).isNotNull()
    mean = F.coalesce(F.when(known, F.col("_mean")), F.col(fallback))
    count = F.when(known, F.col("_count")).otherwise(F.lit(0))
    return found.withColumn(out, shrink(mean, count, fallback, weight)).drop("_mean", "_count")


def current_rate(df: DataFrame, group: str, value: str, out: str, count: str | None = None) -> DataFrame:
    """Mean per group over all rows, groups without name left out."""
    aggs = [mean_of(F.col(value).cast("double")).alias(out)]
    if count:
        aggs.append(F.count(value).alias(count))
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(*aggs)
