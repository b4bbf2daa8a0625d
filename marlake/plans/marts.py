"""Aggregated and model-ready tables over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import whole_hour_days


def order_sums(items: DataFrame) -> DataFrame:
    """Items summed to order grain; removes distinct counts and fan-out from later joins."""
    return items.groupBy("order_id").agg(
        F.sum("price").cast("decimal(18,2)").alias("price"),
        F.sum("freight_value").cast("decimal(18,2)").alias("freight_value"),
        F.count(F.lit(1)).alias("n_items"),
    )


def daily_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with items by purchase day and cohort."""
    joined = orders.select(
        "order_id", F.to_date("order_purchase_timestamp").alias("date_day"), "is_synthetic"
    ).join(order_sums(items.join(orders.select("order_id"), "order_id", "left_semi")), "order_id")
    return joined.groupBy("date_day", "is_synthetic").agg(
        F.count("order_id").alias("order_count"),
        F.sum("price").alias("total_product_revenue"),
        F.sum("freight_value").alias("total_freight_revenue"),
        F.sum(F.col("price") + F.col("freight_value")).alias("total_revenue"),
    )


def merge_daily_revenue(*parts: DataFrame) -> DataFrame:
    """Add up daily revenue computed over disjoint sets of orders."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("date_day", "is_synthetic").agg(
        *[
            F.sum(c).alias(c)
            for c in ("order_count", "total_product_revenue", "total_freight_revenue", "total_revenue")
        ]
    )


def customer_rfm(dim_customers: DataFrame) -> DataFrame:
    spent = F.greatest(F.col("monetary").cast("double"), F.lit(0.0))
    return dim_customers.select(
        "customer_unique_id",
        F.col("recency_days").alias("recency"),
        "monetary",
        F.log1p(F.col("recency_days").cast("double")).alias("recency_log"),
        F.log1p(spent).alias("monetary_log"),
        "is_synthetic",
    )


def top_category(items: DataFrame, products: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: sums, item count and the category of the highest-priced item."""
    priced = items.join(products.select("product_id", "product_category_name_english"), "product_id", "left")
    best = F.struct(F.col("price"), F.col("order_item_id"))
    return priced.groupBy(*keys).agg(
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight_value"),
        F.count(F.lit(1)).alias("n_items"),
        F.max_by("product_category_name_english", best).alias("main_category"),
    )


def main_payment(payments: DataFrame) -> DataFrame:
    """Type of the largest payment and the highest number of installments per order."""
    best = F.struct("payment_value", "payment_sequential")
    return payments.groupBy("order_id").agg(
        F.max_by("payment_type", best).alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"),
    )


def repeat_purchase(orders: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame) -> DataFrame:
    """First order of each person and whether another order followed it.

    The label needs no self-join: an order after the first one exists exactly when the person
    has a second order and the latest purchase lies after the decision time.
    """
    by_time = F.struct("order_purchase_timestamp", "order_id")
    first = (
        orders.where(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(
            F.min_by(
                F.struct(
                    F.col("order_id").alias("order_id"),
                    F.coalesce("order_approved_at", "order_purchase_timestamp").alias("t"),
                    F.col("is_synthetic").alias("is_synthetic"),
                ),
                by_time,
            ).alias("first"),
            F.count(F.lit(1)).alias("n_orders"),
            F.max("order_purchase_timestamp").alias("last_ts"),
        )
        .select("customer_unique_id", "first.*", "n_orders", "last_ts")
    )
    follows = (F.col("n_orders") > 1) & (F.col("last_ts") > F.col("t"))
    return (
        first.join(top_category(items, products, ["order_id"]), "order_id")
        .join(main_payment(payments), "order_id")
        .select(
            "customer_unique_id",
            "is_synthetic",
            F.col("price").alias("first_order_price"),
            F.col("freight_value").alias("first_order_freight"),
            F.col("n_items").alias("first_order_n_items"),
            F.col("main_category").alias("first_order_main_category"),
            "payment_type",
            "payment_installments",
            F.dayofweek("t").alias("purchase_day_of_week"),
            F.month("t").alias("purchase_month"),
            F.when(follows, 1).otherwise(0).alias("repeat_purchase"),
        )
    )


def delivery_delay(
    orders: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame, sellers: DataFrame
) -> DataFrame:
    """Delivered orders at (order, seller) grain with what was known at purchase."""
    delivered = orders.where(
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    )
    return (
        delivered.join(top_category(items, products, ["order_id", "seller_id"]), "order_id")
        .join(main_payment(payments), "order_id")
        .join(sellers.select("seller_id", "seller_state"), "seller_id", "left")
        .select(
            "order_id",
            "seller_id",
            "is_synthetic",
            "price",
            "freight_value",
            "n_items",
            "main_category",
            "payment_type",
            "payment_installments",
            F.dayofweek("order_purchase_timestamp").alias("purchase_day_of_week"),
            F.month("order_purchase_timestamp").alias("purchase_month"),
            whole_hour_days("order_purchase_timestamp", "order_estimated_delivery_date").alias(
                "promised_delivery_days"
            ),
            "seller_state",
            "is_delayed",
        )
    )
