"""Exact quantiles without holding a group's values in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.operators.ordered import running
from marlake.session import stage


def ranked_values(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct values per group with their count ``n``, the rows ``before`` them and ``all`` rows.

    Equal values are counted first (partial aggregation), and the counts are written once; a group
    with very many values is ranked in chunks. Quantiles, moments and histograms can all be read
    from here without another pass over ``df``.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted, "value-counts")
    return running(counted, groups, [value], sums={"before": "n"}, totals={"all": "before"})


def quantiles_of(ranked: DataFrame, value: str, probs: Mapping[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """Quantiles with linear interpolation, one output column per entry of ``probs``."""
    x = F.col(value).cast("double")

    def at(rank):
        inside = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
        return F.max(F.when(inside, x))

    aggs, finals = [], []
    for name, p in probs.items():
        rank = F.lit(float(p)) * (F.col("all") - 1)
        aggs += [
            at(F.floor(rank)).alias(f"_lo_{name}"),
            at(F.ceil(rank)).alias(f"_hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"_w_{name}"),
        ]
        lo, hi, weight = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_w_{name}")
        finals.append((lo + (hi - lo) * weight).alias(name))
    return ranked.groupBy(*groups).agg(*aggs).select(*groups, *finals)


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], groups: Sequence[str] = ()
) -> DataFrame:
    return quantiles_of(ranked_values(df, value, groups), value, probs, groups)


def median(df: DataFrame, value: str, groups: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, groups)
