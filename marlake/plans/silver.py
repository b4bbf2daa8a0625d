"""Bronze to silver: one row per key, fixed types, clean text.

Each function serves the full rebuild and the incremental run alike: pass it the whole bronze
table or only the partitions of some batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import clean_city, clean_state
from marlake.operators.dedup import latest_per_key
from marlake.sources.schemas import MONEY, TABLE_KEYS

LINEAGE = ("is_synthetic", "batch_id", "source_template_date")


def lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def _unique(df: DataFrame, table: str, deduplicated: bool) -> DataFrame:
    if deduplicated:
        return df
    keys = TABLE_KEYS[table]
    if "batch_id" in df.columns:
        return latest_per_key(df, keys)
    return latest_per_key(df.withColumn("batch_id", F.lit(None).cast("string")), keys).drop("batch_id")


def _optional(df: DataFrame, name: str, kind: str):
    """Column ``name`` as ``kind``; null where an input lacks it."""
    col = F.col(name) if name in df.columns else F.lit(None)
    return col.cast(kind).alias(name)


def customers(bronze: DataFrame, deduplicated: bool = False) -> DataFrame:
    df = _unique(bronze, "customers", deduplicated)
    return df.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").cast("string").alias("customer_zip_code_prefix"),
        clean_city("customer_city").alias("customer_city"),
        clean_state("customer_state").alias("customer_state"),
        *lineage(df),
    )


def orders(bronze: DataFrame, deduplicated: bool = False) -> DataFrame:
    df = _unique(bronze, "orders", deduplicated)
    return df.select(
        "order_id",
        "customer_id",
        "order_status",
        *[
            F.col(c).cast("timestamp").alias(c)
            for c in (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ],
        *lineage(df),
    )


def order_items(bronze: DataFrame, deduplicated: bool = False) -> DataFrame:
    df = _unique(bronze, "order_items", deduplicated)
    return df.select(
        "order_id",
        F.col("order_item_id").cast("bigint").alias("order_item_id"),
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").cast("timestamp").alias("shipping_limit_date"),
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
        *lineage(df),
    )


def payments(bronze: DataFrame, deduplicated: bool = False) -> DataFrame:
    df = _unique(bronze, "order_payments", deduplicated)
    return df.select(
        "order_id",
        F.col("payment_sequential").cast("bigint").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("bigint").alias("payment_installments"),
        F.col("payment_value").cast(MONEY).alias("payment_value"),
        *lineage(df),
    )


def reviews(bronze: DataFrame, deduplicated: bool = False) -> DataFrame:
    df = _unique(bronze, "order_reviews", deduplicated)
    return df.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("bigint").alias("review_score"),
        _optional(df, "review_comment_title", "string"),
        _optional(df, "review_comment_message", "string"),
        F.col("review_creation_date").cast("timestamp").alias("review_creation_date"),
        F.col("review_answer_timestamp").cast("timestamp").alias("review_answer_timestamp"),
        *lineage(df),
    )


def products(bronze: DataFrame, translation: DataFrame, deduplicated: bool = False) -> DataFrame:
    """Category name in English, the native name where no translation exists."""
    df = _unique(bronze, "products", deduplicated)
    return df.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", "product_category_name").alias("product_category_name_english"),
        *[
            F.col(c).cast("double").alias(c)
            for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
        ],
        _optional(df, "product_photos_qty", "bigint"),
        *lineage(df),
    )


def sellers(bronze: DataFrame, deduplicated: bool = False) -> DataFrame:
    df = _unique(bronze, "sellers", deduplicated)
    return df.select(
        "seller_id",
        F.col("seller_zip_code_prefix").cast("string").alias("seller_zip_code_prefix"),
        clean_city("seller_city").alias("seller_city"),
        clean_state("seller_state").alias("seller_state"),
        *lineage(df),
    )


def geolocation(bronze: DataFrame) -> DataFrame:
    """One row per zip prefix: mean position, first city and state in sort order."""
    return (
        bronze.withColumn("geolocation_zip_code_prefix", F.col("geolocation_zip_code_prefix").cast("string"))
        .groupBy("geolocation_zip_code_prefix")
        .agg(
            F.avg("geolocation_lat").alias("geolocation_lat"),
            F.avg("geolocation_lng").alias("geolocation_lng"),
            clean_city(F.min("geolocation_city")).alias("geolocation_city"),
            clean_state(F.min("geolocation_state")).alias("geolocation_state"),
        )
    )


def geolocation_modes(bronze: DataFrame) -> DataFrame:
    """Variant with the most frequent city per zip prefix; ties go to the first name."""
    counted = (
        bronze.withColumn("city", clean_city("geolocation_city"))
        .groupBy("geolocation_zip_code_prefix", "city")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("geolocation_zip_code_prefix").agg(
        F.min_by("city", F.struct((-F.col("n")).alias("n"), "city")).alias("geolocation_city"),
        F.max("n").alias("samples"),
    )
