"""The driver's star-schema tables presented with the marketplace schemas (bronze level)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlake.operators.dedup import first_per_key
from marlake.plans import gold, marts, silver
from marlake.session import stage

PERSON = "cast(cast(floor({0} / 3) as bigint) as string)"
COHORT = "cast(floor({0} / 3) as bigint) % 4 = 0"


class Market:
    """Bronze, silver and gold frames over one folder of driver tables, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def written(self) -> Market:
        """Write the deduplicated items once, for queries that read them several times.

        In a lake they are a silver table; here the raw rows would be sorted for each use.
        """
        self.__dict__["items"] = stage(self.items, "items")
        return self

    # --- bronze -----------------------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) customer_id",
            f"{PERSON.format('c_custkey')} customer_unique_id",
            "cast(c_nationkey * 137 as string) customer_zip_code_prefix",
            "concat('  ', c_mktsegment, ' ') customer_city",
            "concat(' st', cast(c_nationkey as string)) customer_state",
            f"{COHORT.format('c_custkey')} is_synthetic",
            "concat(case when cast(floor(c_custkey / 3) as bigint) % 4 = 0 then 'backfill-' else 'historical_' end,"
            " cast(c_custkey % 7 as string)) batch_id",
        )

    @cached_property
    def orders(self) -> DataFrame:
        based = self.table("orders").selectExpr(
            "*", "cast(o_orderdate as timestamp) + ((o_orderkey * 7) % 1440) * interval '1' minute p"
        )
        return based.selectExpr(
            "cast(o_orderkey as string) order_id",
            "cast(o_custkey as string) customer_id",
            "case when o_orderkey % 50 = 0 then 'canceled' when o_orderstatus = 'F' then 'delivered'"
            " when o_orderstatus = 'O' then 'shipped' else 'processing' end order_status",
            "p order_purchase_timestamp",
            "p + interval '1' hour order_approved_at",
            "case when o_orderkey % 31 <> 0 then p + interval '30' hour end order_delivered_carrier_date",
            "case when o_orderstatus = 'F' and o_orderkey % 29 <> 0 then p + ((o_orderkey * 37) % 960) *"
            " interval '1' hour + (o_orderkey % 60) * interval '1' minute end order_delivered_customer_date",
            "cast(o_orderdate as timestamp) + interval '25' day order_estimated_delivery_date",
            f"{COHORT.format('o_custkey')} is_synthetic",
            f"case when {COHORT.format('o_custkey')} then concat('backfill-', cast(cast(o_orderdate as date) as string))"
            " else 'historical_orders' end batch_id",
            f"case when {COHORT.format('o_custkey')} then date_sub(cast(o_orderdate as date), 364) end"
            " source_template_date",
        )

    @cached_property
    def items_raw(self) -> DataFrame:
        """Holds natural duplicates on (order_id, order_item_id)."""
        return self.table("lineitem").selectExpr(
            "cast(l_orderkey as string) order_id",
            "cast(l_linenumber as bigint) order_item_id",
            "cast(l_partkey as string) product_id",
            "cast(l_suppkey as string) seller_id",
            "cast(l_shipdate as timestamp) shipping_limit_date",
            "cast(l_extendedprice as decimal(18,2)) price",
            "cast(l_tax * 1000 + l_quantity as decimal(18,2)) freight_value",
            "concat('backfill-', cast(cast(l_shipdate as date) as string)) batch_id",
            "l_returnflag",
            "l_quantity",
            "l_discount",
            "l_linestatus",
        )

    @cached_property
    def items(self) -> DataFrame:
        order = [F.col("batch_id").desc()] + [
            F.col(c)
            for c in (
                "product_id", "seller_id", "price", "freight_value",
                "l_returnflag", "l_discount", "l_linestatus", "l_quantity",
            )
        ]
        return first_per_key(self.items_raw, ["order_id", "order_item_id"], order).drop("l_discount", "l_linestatus")

    @cached_property
    def payments(self) -> DataFrame:
        return self.items.selectExpr(
            "order_id",
            "order_item_id payment_sequential",
            "case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto' else 'voucher' end payment_type",
            "cast(l_quantity as bigint) % 12 + 1 payment_installments",
            "cast(price + freight_value as decimal(18,2)) payment_value",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Nine orders in ten have a review, a few have two."""
        return (
            self.table("orders")
            .where("o_orderkey % 10 <> 0")
            .withColumn("k", F.explode(F.expr("if(o_orderkey % 97 = 0, array(0, 1), array(0))")))
            .selectExpr(
                "concat('r', cast(o_orderkey as string), '-', cast(k as string)) review_id",
                "cast(o_orderkey as string) order_id",
                "1 + (o_orderkey + k) % 5 review_score",
                "cast(o_orderdate as timestamp) + interval '30' day review_creation_date",
                "cast(o_orderdate as timestamp) + interval '30' day + (o_orderkey % 200) * interval '1' hour"
                " review_answer_timestamp",
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as string) product_id",
            "case when p_partkey % 40 = 0 then null else lower(p_type) end product_category_name",
            "p_size * 50.0D product_weight_g",
            "p_size * 1.0D product_length_cm",
            "10.0D product_height_cm",
            "5.0D + p_size % 7 product_width_cm",
            "cast(p_size % 5 as bigint) product_photos_qty",
        )

    @cached_property
    def translation(self) -> DataFrame:
        """'small' has no translation on purpose."""
        return self.spark.sql(
            "select * from values ('standard', 'std'), ('promo', 'promotion'), ('economy', 'eco'), ('medium', 'mid'),"
            " ('large', 'big') as t(product_category_name, product_category_name_english)"
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "cast(s_suppkey as string) seller_id",
            "cast(s_nationkey * 137 as string) seller_zip_code_prefix",
            "concat(' City', cast(s_nationkey as string), ' ') seller_city",
            "concat('st', cast(s_nationkey as string)) seller_state",
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """Three samples per zip prefix."""
        return (
            self.table("nation")
            .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
            .selectExpr(
                "cast(n_nationkey * 137 as string) geolocation_zip_code_prefix",
                "n_nationkey * 1.5D - 30 + k geolocation_lat",
                "n_nationkey * 0.5D - 60 - k geolocation_lng",
                "concat(n_name, '-', cast(k as string)) geolocation_city",
                "concat('st', cast(n_nationkey as string)) geolocation_state",
            )
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    # --- silver and gold --------------------------------------------------------------------
    # The fixture frames hold one row per key, so only the items table needs its dedup again.
    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver.customers(self.customers, deduplicated=True)

    @cached_property
    def silver_orders(self) -> DataFrame:
        return silver.orders(self.orders, deduplicated=True)

    @cached_property
    def silver_items(self) -> DataFrame:
        return silver.order_items(self.items, deduplicated=True)

    @cached_property
    def silver_payments(self) -> DataFrame:
        return silver.payments(self.payments, deduplicated=True)

    @cached_property
    def silver_reviews(self) -> DataFrame:
        return silver.reviews(self.reviews, deduplicated=True)

    @cached_property
    def silver_products(self) -> DataFrame:
        return silver.products(self.products, self.translation, deduplicated=True)

    @cached_property
    def silver_sellers(self) -> DataFrame:
        return silver.sellers(self.sellers, deduplicated=True)

    @cached_property
    def silver_geolocation(self) -> DataFrame:
        return silver.geolocation(self.geolocation)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return gold.fct_orders(self.silver_orders, self.silver_customers)

    @cached_property
    def order_facts(self) -> DataFrame:
        return gold.order_facts(self.silver_orders)

    @cached_property
    def fct_items(self) -> DataFrame:
        return gold.fct_order_items(self.silver_items)

    @cached_property
    def fct_payments(self) -> DataFrame:
        return gold.fct_payments(self.silver_payments)

    @cached_property
    def fct_reviews(self) -> DataFrame:
        return gold.fct_reviews(self.silver_reviews)

    @cached_property
    def dim_products(self) -> DataFrame:
        # A written dimension has a true size, so Spark picks the right side of a join with items.
        return stage(gold.dim_products(self.silver_products), "dim-products")

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return gold.dim_sellers(self.silver_sellers)

    @cached_property
    def dim_geolocation(self) -> DataFrame:
        return gold.dim_geolocation(self.silver_geolocation)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.silver_customers, self.silver_orders, self.silver_payments)

    @cached_property
    def mart_daily_revenue(self) -> DataFrame:
        return marts.daily_revenue(self.order_facts, self.fct_items)

    @cached_property
    def mart_customer_rfm(self) -> DataFrame:
        return marts.customer_rfm(self.dim_customers)
