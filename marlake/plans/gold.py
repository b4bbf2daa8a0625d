"""Silver to gold: facts and dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlake.functions.expr import sunday_week_of_year, whole_hour_days
from marlake.operators.dedup import first_per_key
from marlake.plans.silver import lineage

# Recency limits of the customer labels, in days.
ACTIVE_DAYS = 90
AT_RISK_DAYS = 180


# --- facts ----------------------------------------------------------------------------------
def delivery_days() -> Column:
    """Whole hours from purchase to delivery / 24, for delivered orders only."""
    done = (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    return F.when(done, whole_hour_days("order_purchase_timestamp", "order_delivered_customer_date"))


def is_delayed() -> Column:
    """True, false, or null while the answer is not defined."""
    defined = (
        (F.col("order_status") == "delivered")
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )
    return F.when(defined, F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))


def order_facts(orders: DataFrame) -> DataFrame:
    """Order facts without the person, for reads that do not need the customer join."""
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        delivery_days().alias("delivery_days"),
        is_delayed().alias("is_delayed"),
        *lineage(orders),
    )


def fct_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    facts = order_facts(orders)
    persons = customers.select("customer_id", "customer_unique_id")
    first, second, *rest = facts.columns
    return facts.join(persons, "customer_id", "left").select(first, second, "customer_unique_id", *rest)


def fct_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        *lineage(items),
    )


def fct_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        *lineage(payments),
    )


def fct_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "order_id",
        "review_score",
        "review_creation_date",
        "review_answer_timestamp",
        whole_hour_days("review_creation_date", "review_answer_timestamp").alias("review_response_days"),
        *lineage(reviews),
    )


# --- dimensions -----------------------------------------------------------------------------
def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_photos_qty",
        *[c for c in lineage(products) if c == "is_synthetic"],
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        *[c for c in lineage(sellers) if c == "is_synthetic"],
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    return geolocation.select(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    )


def customer_profile(customers: DataFrame) -> DataFrame:
    """One profile per person: that of the first customer id."""
    return first_per_key(
        customers.select(
            "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
        ),
        ["customer_unique_id"],
        [F.col("customer_id")],
    ).drop("customer_id")


def order_values(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their person and the sum of their payments (0 without payment)."""
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").cast("decimal(18,2)").alias("paid"))
    persons = customers.select("customer_id", "customer_unique_id")
    return (
        orders.select("order_id", "customer_id", "order_purchase_timestamp", "is_synthetic")
        .join(paid, "order_id", "left")
        .join(persons, "customer_id", "left")
        .select(
            "customer_unique_id",
            "order_id",
            "order_purchase_timestamp",
            "is_synthetic",
            F.coalesce("paid", F.lit(0)).cast("decimal(18,2)").alias("order_payment_value"),
        )
    )


def cohort_reference(orders: DataFrame) -> DataFrame:
    """Reference time of each cohort; the two live on unrelated timelines."""
    return orders.groupBy("is_synthetic").agg(F.max("order_purchase_timestamp").alias("as_of_timestamp"))


def customer_rfm(values: DataFrame) -> DataFrame:
    """First and last purchase, number and value of orders per person (orders are unique)."""
    return values.groupBy("customer_unique_id").agg(
        F.min("order_purchase_timestamp").alias("first_purchase_at"),
        F.max("order_purchase_timestamp").alias("last_purchase_at"),
        F.count("order_id").alias("frequency"),
        F.sum("order_payment_value").alias("monetary"),
        F.max("is_synthetic").alias("is_synthetic"),
    )


def segment_label(recency: Column) -> Column:
    return (
        F.when(recency <= ACTIVE_DAYS, "active").when(recency <= AT_RISK_DAYS, "at_risk").otherwise("lost")
    )


def dim_customers(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    rfm = customer_rfm(order_values(orders, customers, payments))
    # Three rows at most: true, false, null.
    reference = F.broadcast(cohort_reference(orders))
    recency = F.datediff(F.to_date("as_of_timestamp"), F.to_date("last_purchase_at"))
    return (
        rfm.join(customer_profile(customers), "customer_unique_id")
        .join(reference, "is_synthetic")
        .select(
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
            "first_purchase_at",
            "last_purchase_at",
            "frequency",
            "monetary",
            recency.alias("recency_days"),
            F.when(F.col("frequency") > 1, "repeat").otherwise("one_time").alias("customer_type"),
            segment_label(recency).alias("segment_label"),
            "is_synthetic",
        )
    )


def date_spine(spark: SparkSession, start: str = "2016-01-01", end: str = "2030-12-31") -> DataFrame:
    """Every day from ``start`` up to, not including, ``end``."""
    days = f"sequence(date'{start}', date_sub(date'{end}', 1))"
    return spark.sql(f"select explode({days}) as date_day")


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes of the days in column ``date_day``."""
    d = F.col("date_day")
    return days.select(
        "date_day",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        sunday_week_of_year(d).alias("week_of_year"),
    )
