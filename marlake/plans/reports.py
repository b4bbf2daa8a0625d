"""Read queries of the operations dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import mean_of, ratio, sunday_week_start
from marlake.plans.marts import order_sums
from marlake.plans.scoring import tier_rank
from marlake.sources.lake import Lake

TREND_DAYS = 90


def _date(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def purchase_day() -> Column:
    return F.to_date("order_purchase_timestamp")


def kpi_overview(orders: DataFrame, items: DataFrame, as_of: str) -> DataFrame:
    """Revenue and orders of the day and the day before, and their relative change, in one pass.

    The time filter comes first, so only items of two days are aggregated.
    """
    start = F.date_sub(_date(as_of), 1).cast("timestamp")
    end = F.date_add(_date(as_of), 1).cast("timestamp")
    ts = F.col("order_purchase_timestamp")
    recent = orders.where(F.col("is_synthetic") & (ts >= start) & (ts < end)).select(
        "order_id", purchase_day().alias("day")
    )
    amount = F.col("price") + F.col("freight_value")
    per_order = (
        recent.join(items.select("order_id", amount.alias("amount")), "order_id", "left")
        .groupBy("order_id", "day")
        .agg(F.sum("amount").alias("amount"))
    )
    today, yesterday = F.col("day") == _date(as_of), F.col("day") == F.date_sub(_date(as_of), 1)
    row = per_order.agg(
        F.sum(F.when(today, F.col("amount"))).alias("revenue_today"),
        F.count_if(today).alias("orders_today"),
        F.sum(F.when(yesterday, F.col("amount"))).alias("revenue_yesterday"),
        F.count_if(yesterday).alias("orders_yesterday"),
    )

    def change(now, before):
        return ratio(F.col(now).cast("double") - F.col(before).cast("double"), before)

    return row.withColumns(
        {
            "revenue_change": change("revenue_today", "revenue_yesterday"),
            "orders_change": change("orders_today", "orders_yesterday"),
        }
    )


def trend(daily_revenue: DataFrame, as_of: str, days: int = TREND_DAYS) -> DataFrame:
    return (
        daily_revenue.where(F.col("is_synthetic") & (F.col("date_day") >= F.date_sub(_date(as_of), days)))
        .select(
            F.col("date_day").alias("ds"), F.col("order_count").alias("orders"), F.col("total_revenue").alias("revenue")
        )
        .orderBy("ds")
    )


def trend_with_forecast(trend_rows: DataFrame, forecast: DataFrame | None) -> DataFrame:
    """Actuals followed by the forecast; without a forecast its columns stay empty."""
    typed = trend_rows.withColumns({c: F.lit(None).cast("double") for c in ("yhat", "yhat_lower", "yhat_upper")})
    if forecast is None:
        return typed.orderBy("ds")
    return typed.unionByName(
        forecast.select("ds", "yhat", "yhat_lower", "yhat_upper"), allowMissingColumns=True
    ).orderBy("ds")


def revenue_by_category(orders: DataFrame, items: DataFrame, products: DataFrame, limit: int | None = 10) -> DataFrame:
    """Revenue and orders per category, largest first."""
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    named = products.select("product_id", category.alias("category"))
    # Order grain first: the distinct count of orders becomes a count, and a hot category is
    # already reduced before it is shuffled by name.
    per_order = (
        items.select("order_id", "product_id", (F.col("price") + F.col("freight_value")).alias("amount"))
        .join(named, "product_id")
        .groupBy("order_id", "category")
        .agg(F.sum("amount").alias("amount"))
    )
    ranked = (
        per_order.join(orders.where("is_synthetic").select("order_id"), "order_id", "left_semi")
        .groupBy("category")
        .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .orderBy(F.col("revenue").desc(), "category")
    )
    return ranked if limit is None else ranked.limit(limit)


def revenue_by_state(orders: DataFrame, items: DataFrame, profiles: DataFrame) -> DataFrame:
    live = orders.where("is_synthetic").select("order_id", "customer_unique_id")
    return (
        live.join(order_sums(items.join(live.select("order_id"), "order_id", "left_semi")), "order_id")
        .groupBy("customer_unique_id")
        .agg(
            F.sum(F.col("price") + F.col("freight_value")).alias("amount"), F.count(F.lit(1)).alias("n")
        )
        .join(profiles.select("customer_unique_id", F.col("customer_state").alias("state")), "customer_unique_id")
        .groupBy("state")
        .agg(F.sum("amount").alias("revenue"), F.sum("n").alias("orders"))
        .orderBy(F.col("revenue").desc(), "state")
    )


def delivery_performance(orders: DataFrame, grain: str, as_of: str | None = None) -> DataFrame:
    """On-time rate and mean delivery days per day (last 90 days) or per Sunday week (all)."""
    done = orders.where(
        F.col("is_synthetic") & (F.col("order_status") == "delivered") & F.col("is_delayed").isNotNull()
    )
    return _by_period(
        done,
        grain,
        as_of,
        [
            F.count(F.lit(1)).alias("delivered_orders"),
            ratio(F.count_if(~F.col("is_delayed")), F.count(F.lit(1))).alias("on_time_rate"),
            mean_of("delivery_days").alias("avg_delivery_days"),
        ],
    )


def review_trend(orders: DataFrame, reviews: DataFrame, grain: str, as_of: str | None = None) -> DataFrame:
    """Mean score, share of scores of at most 2 and number of reviews per day or week."""
    placed = orders.where("is_synthetic").select("order_id", "order_purchase_timestamp")
    if as_of is not None and grain == "day":
        placed = placed.where(purchase_day() >= F.date_sub(_date(as_of), TREND_DAYS))
    joined = reviews.select("order_id", "review_score").join(placed, "order_id")
    return _by_period(
        joined,
        grain,
        None,
        [
            mean_of("review_score").alias("avg_score"),
            ratio(F.count_if(F.col("review_score") <= 2), F.count(F.lit(1))).alias("negative_rate"),
            F.count(F.lit(1)).alias("n_reviews"),
        ],
    )


def _by_period(df: DataFrame, grain: str, as_of: str | None, aggs: list[Column]) -> DataFrame:
    if grain == "day":
        if as_of is not None:
            df = df.where(purchase_day() >= F.date_sub(_date(as_of), TREND_DAYS))
        name, period = "ds", purchase_day()
    else:
        name, period = "week_start", sunday_week_start(purchase_day())
    return df.groupBy(period.alias(name)).agg(*aggs).orderBy(name)


def top_list(
    df: DataFrame, by: str, key: str, label: str | None = None, value: str | None = None, limit: int = 200
) -> DataFrame:
    """First rows by a score, optionally of one label only; equal scores order by key."""
    chosen = df if value is None else df.where(F.col(label) == F.lit(value))
    return chosen.orderBy(F.col(by).desc(), key).limit(limit)


def stored_list(lake: Lake, table: str, by: str, key: str, label: str | None = None, value: str | None = None, limit: int = 200) -> DataFrame | None:
    """First rows of the latest run of a scoring table, without its time stamp; None where there has been no run."""
    scores = lake.current("predictions", table)
    return None if scores is None else top_list(scores.drop("scored_at"), by, key, label, value, limit)


def stored_counts(lake: Lake, table: str, label: str) -> DataFrame | None:
    """Rows per label in the latest run of a scoring table."""
    scores = lake.current("predictions", table)
    return None if scores is None else label_counts(scores, label)


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def tier_summary(df: DataFrame) -> DataFrame:
    return label_counts(df, "risk_tier").withColumn("tier_rank", tier_rank()).orderBy("tier_rank")


def share_of_max(aggregated: DataFrame, value: str) -> DataFrame:
    """Each row's value relative to the largest one of an aggregated report."""
    largest = aggregated.agg(F.max(value).alias("m")).scalar()
    return aggregated.withColumn("share_of_max", ratio(value, largest))


def on_time_rate(delay_rate: str) -> Column:
    return F.lit(1.0) - F.col(delay_rate)
