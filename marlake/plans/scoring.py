"""Tiers, actions and cluster names derived from model output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.operators.ordered import running
from marlake.operators.quantiles import exact_quantiles

# Tier limits and labels, action texts, cluster names and limits.
TIER_LIMITS = [(0.5, "Low"), (0.8, "Medium"), (0.95, "High")]
TOP_TIER = "Critical"
TIER_ORDER = ["Critical", "High", "Medium", "Low"]

LAPSED = ["Lapsed & High-Value", "Lapsed & Low-Value"]
ACTION_VOUCHER = "Retention voucher (lapsed, high predicted future value)"
ACTION_WIN_BACK = "Win-back offer (lapsed, historically high value)"
ACTION_EMAIL = "Low-cost re-engagement email (lapsed, low predicted value)"
ACTION_NONE = "No action / monitor"
ACTIONS = [ACTION_VOUCHER, ACTION_WIN_BACK, ACTION_EMAIL, ACTION_NONE]
CUSTOMER_SEGMENTS = ["Recent & High-Value", "Recent & Modest-Spend", *LAPSED]

LOW_REVIEW = 3.9
HIGH_DELAY = 0.12


def risk_tiers(df: DataFrame, score: str, key: str, out: str = "risk_tier") -> DataFrame:
    """Tier of each row by its rank among all rows; equal scores rank by key.

    Only scores and keys are ranked. What comes out is the last (score, key) of each tier, and the
    rows themselves are compared with these limits where they are.
    """
    at = F.struct(F.col(score).alias("score"), F.col(key).alias("key"))
    ranked = running(df.select(score, key), [], [score, key], sums={"_pos": F.lit(1)}, totals={"_rows": "_pos"})
    share = F.col("_pos") / F.greatest(F.col("_rows") - 1, F.lit(1))
    ends = ranked.agg(*[F.max(F.when(share <= limit, at)).alias(name) for limit, name in TIER_LIMITS])
    marked = df.withColumn("_ends", ends.select(F.struct(*[name for _, name in TIER_LIMITS])).scalar())
    label: Column | None = None
    for _, name in TIER_LIMITS:
        within = at <= F.col(f"_ends.{name}")
        label = F.when(within, name) if label is None else label.when(within, name)
    return marked.withColumn(out, label.otherwise(TOP_TIER)).drop("_ends")


def tier_rank(tier: str = "risk_tier") -> Column:
    """Position of a tier in the display order Critical, High, Medium, Low."""
    return F.array_position(F.array(*[F.lit(t) for t in TIER_ORDER]), F.col(tier))


def suggested_action(df: DataFrame, value: str = "predicted_incremental_value") -> DataFrame:
    """Action per customer from segment and predicted value; the first rule that fits wins."""
    cuts = exact_quantiles(df, value, {"p33": 0.33, "p66": 0.66})
    marked = df.withColumn("_cut", cuts.select(F.struct("p33", "p66")).scalar())
    lapsed = F.col("segment").isin(LAPSED)
    action = (
        F.when(lapsed & (F.col(value) >= F.col("_cut.p66")), ACTION_VOUCHER)
        .when(F.col("segment") == LAPSED[0], ACTION_WIN_BACK)
        .when(lapsed & (F.col(value) <= F.col("_cut.p33")), ACTION_EMAIL)
        .otherwise(ACTION_NONE)
    )
    return marked.withColumn("suggested_action", action).drop("_cut")


def customer_cluster_labels(clustered: DataFrame) -> DataFrame:
    """Name of each customer cluster from its mean recency and spend (one row per cluster)."""
    centers = clustered.groupBy("cluster").agg(
        F.avg(F.col("recency").cast("double")).alias("avg_recency"),
        F.avg(F.col("monetary").cast("double")).alias("avg_monetary"),
    )
    # k rows: the medians are over the cluster means, not over the customers.
    mids = centers.agg(F.struct(F.median("avg_recency").alias("r"), F.median("avg_monetary").alias("m"))).scalar()
    recent = F.col("avg_recency") <= F.col("_mid.r")
    high = F.col("avg_monetary") >= F.col("_mid.m")
    label = (
        F.when(recent & high, CUSTOMER_SEGMENTS[0])
        .when(recent, CUSTOMER_SEGMENTS[1])
        .when(high, CUSTOMER_SEGMENTS[2])
        .otherwise(CUSTOMER_SEGMENTS[3])
    )
    return centers.withColumn("_mid", mids).select("cluster", "avg_recency", "avg_monetary", label.alias("segment"))


def seller_cluster_labels(clustered: DataFrame) -> DataFrame:
    """Name of each seller cluster from its mean review, delay and revenue."""
    centers = clustered.groupBy("cluster").agg(
        F.avg(F.col("n_orders").cast("double")).alias("n_orders"),
        F.avg(F.col("revenue").cast("double")).alias("revenue"),
        F.avg("delay_rate").alias("delay_rate"),
        F.avg("review_score").alias("review_score"),
    )
    mid = centers.agg(F.median("revenue").alias("m")).scalar()
    at_risk = (F.col("review_score") < LOW_REVIEW) | (F.col("delay_rate") > HIGH_DELAY)
    label = (
        F.when(at_risk, "At-Risk Seller")
        .when(F.col("revenue") >= F.col("_mid"), "Top Seller")
        .otherwise("Small/Low-Volume Seller")
    )
    return centers.withColumn("_mid", mid).select(
        "cluster", "n_orders", "revenue", "delay_rate", "review_score", label.alias("segment")
    )


def name_clusters(clustered: DataFrame, labels: DataFrame) -> DataFrame:
    """Put the cluster names on the rows; an unnamed cluster shows its number."""
    # One row per cluster, so the side is as small as k.
    named = clustered.join(F.broadcast(labels.select("cluster", "segment")), "cluster", "left")
    return named.withColumn(
        "segment", F.coalesce("segment", F.concat(F.lit("cluster_"), F.col("cluster").cast("string")))
    )
