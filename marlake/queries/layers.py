"""Sources, silver, gold and marts."""

from pyspark.sql import functions as F

from marlake.functions.expr import decimals_to_double
from marlake.operators.dedup import latest_per_key
from marlake.plans import gold, marts, silver
from marlake.plans.features import top_payment
from marlake.queries.registry import query
from marlake.sources import files, lake
from marlake.sources.schemas import TABLE_KEYS

ITEM_TIES = [
    "product_id", "seller_id", "price", "freight_value", "l_returnflag", "l_discount", "l_linestatus", "l_quantity",
]


# --- sources --------------------------------------------------------------------------------
@query(
    "src_reconcile",
    """
select 'customers' table_name, (select count(*) from customer) source_rows, (select count(distinct customer_id) from v_customers) loaded_rows,
  (select count(*) from customer) = (select count(distinct customer_id) from v_customers) "matches"
union all select 'order_items', (select count(*) from lineitem), (select count(*) from v_items), (select count(*) from lineitem) = (select count(*) from v_items)
union all select 'orders', (select count(*) from orders), (select count(*) from v_orders), (select count(*) from orders) = (select count(*) from v_orders)""",
)
def src_reconcile(m):
    source = {"customers": m.table("customer"), "order_items": m.table("lineitem"), "orders": m.table("orders")}
    return files.reconcile(
        source,
        {"customers": silver.customers(m.customers), "order_items": m.silver_items, "orders": m.silver_orders},
    )


@query(
    "bronze_tag",
    """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, false is_synthetic,
  'historical_customers' batch_id, cast(null as varchar) source_template_date
from v_customers""",
)
def bronze_tag(m):
    return files.tag(m.customers, "historical_customers", False)


@query(
    "dedup_keep_first",
    """
select geolocation_zip_code_prefix, round(geolocation_lat, 6) geolocation_lat, round(geolocation_lng, 6) geolocation_lng,
  geolocation_city, geolocation_state, c.n customers
from (select *, row_number() over (partition by geolocation_zip_code_prefix order by geolocation_lat, geolocation_lng,
        geolocation_city, geolocation_state) rn from v_geolocation) g
join (select customer_zip_code_prefix z, count(*) n from v_customers group by 1) c on c.z = g.geolocation_zip_code_prefix
where rn = 1""",
)
def dedup_keep_first(m):
    """First sample per zip prefix, with the customers that live there."""
    living = m.customers.groupBy(F.col("customer_zip_code_prefix").alias("geolocation_zip_code_prefix")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    return files.keep_first_zip(m.geolocation).join(living, "geolocation_zip_code_prefix")


@query(
    "batch_already_loaded",
    """
select distinct batch_id from v_orders
where batch_id in ('historical_orders', 'backfill-1995-01-01', 'backfill-1998-02-03', 'backfill-1999-12-31', 'live-2024-01-01-00-06')""",
)
def batch_already_loaded(m):
    wanted = [
        "historical_orders", "backfill-1995-01-01", "backfill-1998-02-03", "backfill-1999-12-31", "live-2024-01-01-00-06",
    ]
    return m.orders.where(F.col("batch_id").isin(wanted)).select("batch_id").distinct()


@query(
    "schema_evolve_union",
    """
select order_id, order_status, batch_id, null source_template_date from v_orders where not is_synthetic
union all select order_id, order_status, batch_id, cast(source_template_date as varchar) from v_orders where is_synthetic""",
)
def schema_evolve_union(m):
    """Historical batch without the template date, then a batch that brings the column."""
    old = m.orders.where("not is_synthetic").select("order_id", "order_status", "batch_id")
    new = m.orders.where("is_synthetic").select("order_id", "order_status", "batch_id", "source_template_date")
    return lake.add_columns_union(old, new)


@query(
    "latest_checkpoint",
    """
select event_type pipeline_name, arg_max(ts, ts + to_hours(cast(event_id % 50 as integer))) last_processed_at,
  max(ts + to_hours(cast(event_id % 50 as integer))) updated_at
from (select *, row_number() over (partition by event_type order by ts + to_hours(cast(event_id % 50 as integer)) desc, ts desc) rn from events) t
where rn = 1 group by 1""",
)
def latest_checkpoint(m):
    """Events as a checkpoint log: one pipeline per type, written some hours after the event."""
    states = m.events.selectExpr(
        "event_type pipeline_name",
        "ts last_processed_at",
        "ts + (event_id % 50) * interval '1' hour updated_at",
    )
    return lake.latest_state(states)


@query(
    "pool_limit",
    """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, is_synthetic
from v_customers where is_synthetic""",
)
def pool_limit(m):
    return lake.synthetic_pool(m.customers)


@query(
    "decimal_to_double",
    """
select order_id, order_item_id, cast(price as double) price, cast(freight_value as double) freight_value from v_items_raw""",
)
def decimal_to_double(m):
    return decimals_to_double(m.items_raw.select("order_id", "order_item_id", "price", "freight_value"))


# --- silver ---------------------------------------------------------------------------------
@query(
    "dedup_latest_1key",
    """
select order_id, order_item_id, product_id, seller_id, batch_id from (
  select *, row_number() over (partition by order_id order by batch_id desc, order_item_id, product_id, seller_id, price, freight_value,
    l_returnflag, l_discount, l_linestatus, l_quantity) rn from v_items_raw) t where rn = 1""",
)
def dedup_latest_1key(m):
    found = latest_per_key(m.items_raw, ["order_id"], tiebreak=["order_item_id", *ITEM_TIES])
    return found.select("order_id", "order_item_id", "product_id", "seller_id", "batch_id")


@query(
    "dedup_latest_2key",
    "select order_id, order_item_id, product_id, seller_id, cast(price as double) price, batch_id from v_items",
)
def dedup_latest_2key(m):
    found = latest_per_key(m.items_raw, TABLE_KEYS["order_items"], tiebreak=ITEM_TIES)
    return found.select("order_id", "order_item_id", "product_id", "seller_id", "price", "batch_id")


@query("silver_customers", "select * from g_customers")
def silver_customers(m):
    return silver.customers(m.customers)


@query(
    "silver_orders",
    """
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
  order_delivered_customer_date, order_estimated_delivery_date, is_synthetic, batch_id,
  cast(source_template_date as varchar) source_template_date
from v_orders""",
)
def silver_orders(m):
    return silver.orders(m.orders)


@query(
    "silver_order_items",
    """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date, cast(price as double) price,
  cast(freight_value as double) freight_value, batch_id
from (select *, row_number() over (partition by order_id, order_item_id order by batch_id desc, product_id, seller_id,
        shipping_limit_date, price, freight_value) rn from v_items_raw) t where rn = 1""",
)
def silver_order_items(m):
    return silver.order_items(m.items_raw.drop("l_returnflag", "l_discount", "l_linestatus", "l_quantity"))


@query(
    "silver_payments",
    "select order_id, payment_sequential, payment_type, payment_installments, cast(payment_value as double) payment_value from v_payments",
)
def silver_payments(m):
    return silver.payments(m.payments)


@query(
    "silver_reviews",
    """
select review_id, order_id, review_score, cast(null as varchar) review_comment_title, cast(null as varchar) review_comment_message,
  review_creation_date, review_answer_timestamp
from v_reviews""",
)
def silver_reviews(m):
    return silver.reviews(m.reviews)


@query("silver_products", "select * from g_products")
def silver_products(m):
    return silver.products(m.products, m.translation)


@query("silver_sellers", "select * from g_sellers")
def silver_sellers(m):
    return silver.sellers(m.sellers)


GEO_SQL = """
select geolocation_zip_code_prefix, round(geolocation_lat, 6) geolocation_lat, round(geolocation_lng, 6) geolocation_lng,
  geolocation_city, geolocation_state, {0}
from g_geo g left join ({1}) c on c.z = g.geolocation_zip_code_prefix"""


@query(
    "silver_geolocation",
    GEO_SQL.format("coalesce(c.n, 0) customers", "select customer_zip_code_prefix z, count(*) n from v_customers group by 1"),
)
def silver_geolocation(m):
    """Zip dimension with the customers of each prefix."""
    living = m.customers.groupBy(F.col("customer_zip_code_prefix").alias("geolocation_zip_code_prefix")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    joined = m.silver_geolocation.join(living, "geolocation_zip_code_prefix", "left")
    return joined.withColumn("customers", F.coalesce("customers", F.lit(0)))


@query(
    "geolocation_modes",
    """
select customer_zip_code_prefix geolocation_zip_code_prefix, city geolocation_city, n samples from (
  select *, row_number() over (partition by customer_zip_code_prefix order by n desc, city) rn from (
    select customer_zip_code_prefix, trim(lower(customer_city)) city, count(*) n from v_customers group by 1, 2) a) t where rn = 1""",
)
def geolocation_modes(m):
    """Most frequent city text per zip prefix, from the customers' own addresses."""
    return silver.geolocation_modes(
        m.customers.select(
            F.col("customer_zip_code_prefix").alias("geolocation_zip_code_prefix"),
            F.col("customer_city").alias("geolocation_city"),
        )
    )


# --- gold -----------------------------------------------------------------------------------
@query(
    "fct_orders",
    """
select * exclude (delivery_days, source_template_date), round(delivery_days, 6) delivery_days,
  cast(source_template_date as varchar) source_template_date
from g_orders""",
)
def fct_orders(m):
    return m.fct_orders


@query(
    "fct_order_items",
    """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date, cast(price as double) price,
  cast(freight_value as double) freight_value, batch_id from v_items""",
)
def fct_order_items(m):
    return m.fct_items


@query(
    "fct_payments",
    "select order_id, payment_sequential, payment_type, payment_installments, cast(payment_value as double) payment_value from v_payments",
)
def fct_payments(m):
    return m.fct_payments


@query("fct_reviews", "select * exclude (review_response_days), round(review_response_days, 6) review_response_days from g_reviews")
def fct_reviews(m):
    return m.fct_reviews


@query("dim_customer_profile", "select * from g_profile")
def dim_customer_profile(m):
    return gold.customer_profile(m.silver_customers)


@query("order_payment_value", "select * exclude (order_payment_value), cast(order_payment_value as double) order_payment_value from g_values")
def order_payment_value(m):
    return gold.order_values(m.silver_orders, m.silver_customers, m.silver_payments)


@query(
    "cohort_reference_date",
    "select is_synthetic, max(order_purchase_timestamp) as_of_timestamp from g_values group by is_synthetic",
)
def cohort_reference_date(m):
    return gold.cohort_reference(m.silver_orders)


@query(
    "customer_rfm",
    """
select customer_unique_id, min(order_purchase_timestamp) first_purchase_at, max(order_purchase_timestamp) last_purchase_at,
  count(distinct order_id) frequency, cast(sum(order_payment_value) as double) monetary, bool_or(is_synthetic) is_synthetic
from g_values group by 1""",
)
def customer_rfm(m):
    return gold.customer_rfm(gold.order_values(m.silver_orders, m.silver_customers, m.silver_payments))


@query("dim_customers", "select * exclude (monetary), cast(monetary as double) monetary from g_dim_customers")
def dim_customers(m):
    return m.dim_customers


@query(
    "dim_date",
    """
select cast(d as varchar) date_day, year(d) "year", quarter(d) "quarter", month(d) "month", monthname(d) month_name, day(d) day_of_month,
  dayofweek(d) + 1 day_of_week, dayname(d) day_name, dayofweek(d) + 1 in (1, 7) is_weekend,
  cast(strftime(d, '%U') as integer) week_of_year, n.orders
from (select distinct cast(order_purchase_timestamp as date) d, count(*) orders from v_orders group by 1) n""",
)
def dim_date(m):
    """Calendar attributes of every day with orders."""
    days = m.orders.groupBy(F.to_date("order_purchase_timestamp").alias("date_day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return gold.dim_date(days).join(days, "date_day")


@query("dim_products", "select * from g_products")
def dim_products(m):
    return m.dim_products


@query("dim_sellers", "select * from g_sellers")
def dim_sellers(m):
    return m.dim_sellers


@query(
    "dim_geolocation",
    GEO_SQL.format("coalesce(c.n, 0) sellers", "select seller_zip_code_prefix z, count(*) n from v_sellers group by 1"),
)
def dim_geolocation(m):
    """Zip dimension with the sellers of each prefix."""
    based = m.sellers.groupBy(F.col("seller_zip_code_prefix").alias("geolocation_zip_code_prefix")).agg(
        F.count(F.lit(1)).alias("sellers")
    )
    joined = m.dim_geolocation.join(based, "geolocation_zip_code_prefix", "left")
    return joined.withColumn("sellers", F.coalesce("sellers", F.lit(0)))


@query(
    "cohort_filter",
    """
select 'historical' cohort, count(*) orders, min(order_purchase_timestamp) first_order from v_orders where not is_synthetic
union all select 'synthetic', count(*), min(order_purchase_timestamp) from v_orders where is_synthetic
union all select 'both', count(*), min(order_purchase_timestamp) from v_orders""",
)
def cohort_filter(m):
    def one(name, df):
        return df.agg(
            F.count(F.lit(1)).alias("orders"), F.min("order_purchase_timestamp").alias("first_order")
        ).select(F.lit(name).alias("cohort"), "orders", "first_order")

    return (
        one("historical", m.orders.where(~F.col("is_synthetic")))
        .unionByName(one("synthetic", m.orders.where("is_synthetic")))
        .unionByName(one("both", m.orders))
    )


# --- marts ----------------------------------------------------------------------------------
DAILY_SQL = """
select cast(date_day as varchar) date_day, is_synthetic, order_count, cast(total_product_revenue as double) total_product_revenue,
  cast(total_freight_revenue as double) total_freight_revenue, cast(total_revenue as double) total_revenue
from g_daily"""


@query("mart_daily_revenue", DAILY_SQL)
def mart_daily_revenue(m):
    return m.mart_daily_revenue


@query(
    "mart_customer_rfm",
    """
select customer_unique_id, recency, cast(monetary as double) monetary, round(recency_log, 6) recency_log,
  round(monetary_log, 6) monetary_log, is_synthetic from g_rfm""",
)
def mart_customer_rfm(m):
    return m.mart_customer_rfm


MAIN_PAYMENT = """(select order_id, max(case when rn = 1 then payment_type end) payment_type, max(payment_installments) payment_installments
  from (select *, row_number() over (partition by order_id order by payment_value desc, payment_sequential desc) rn from v_payments) x group by 1)"""


REPEAT_SQL = f"""
with first_order as (
  select * from (select customer_unique_id, order_id, coalesce(order_approved_at, order_purchase_timestamp) t, is_synthetic,
    row_number() over (partition by customer_unique_id order by order_purchase_timestamp, order_id) rn
    from g_orders where customer_unique_id is not null) z where rn = 1),
items as (
  select f.customer_unique_id, sum(i.price) price, sum(i.freight_value) freight, count(*) n,
    max(case when i.rk = 1 then i.cat end) cat
  from first_order f join (select i.*, p.product_category_name_english cat,
      row_number() over (partition by i.order_id order by i.price desc, i.order_item_id desc) rk
      from v_items i left join g_products p on p.product_id = i.product_id) i on i.order_id = f.order_id group by 1),
label as (
  select f.customer_unique_id, max(case when o.order_id <> f.order_id and o.order_purchase_timestamp > f.t then 1 else 0 end) y
  from first_order f join g_orders o on o.customer_unique_id = f.customer_unique_id group by 1)
select f.customer_unique_id, f.is_synthetic, cast(i.price as double) first_order_price, cast(i.freight as double) first_order_freight,
  i.n first_order_n_items, i.cat first_order_main_category, p.payment_type, p.payment_installments,
  dayofweek(f.t) + 1 purchase_day_of_week, month(f.t) purchase_month, l.y repeat_purchase
from first_order f join items i on i.customer_unique_id = f.customer_unique_id join {MAIN_PAYMENT} p on p.order_id = f.order_id
join label l on l.customer_unique_id = f.customer_unique_id"""


@query("mart_repeat_purchase", REPEAT_SQL)
def mart_repeat_purchase(m):
    m = m.written()
    return marts.repeat_purchase(m.fct_orders, m.fct_items, m.dim_products, m.fct_payments)


DELAY_SQL = f"""
with items as (
  select order_id, seller_id, sum(price) price, sum(freight_value) freight_value, count(*) n_items, max(case when rk = 1 then cat end) main_category
  from (select i.*, p.product_category_name_english cat,
      row_number() over (partition by i.order_id, i.seller_id order by i.price desc, i.order_item_id desc) rk
      from v_items i left join g_products p on p.product_id = i.product_id) x group by 1, 2)
select o.order_id, i.seller_id, o.is_synthetic, cast(i.price as double) price, cast(i.freight_value as double) freight_value, i.n_items,
  i.main_category, p.payment_type, p.payment_installments, dayofweek(o.order_purchase_timestamp) + 1 purchase_day_of_week,
  month(o.order_purchase_timestamp) purchase_month,
  round(datesub('hour', o.order_purchase_timestamp, o.order_estimated_delivery_date) / 24.0e0, 6) promised_delivery_days,
  s.seller_state, o.is_delayed
from g_orders o join items i on i.order_id = o.order_id join {MAIN_PAYMENT} p on p.order_id = o.order_id
left join g_sellers s on s.seller_id = i.seller_id
where o.order_status = 'delivered' and o.order_delivered_customer_date is not null"""


@query("mart_delivery_delay", DELAY_SQL)
def mart_delivery_delay(m):
    m = m.written()
    return marts.delivery_delay(m.order_facts, m.fct_items, m.dim_products, m.fct_payments, m.dim_sellers)


@query(
    "main_category_by_price",
    """
select order_id, cat main_category from (select i.order_id, p.product_category_name_english cat,
  row_number() over (partition by i.order_id order by i.price desc, i.order_item_id desc) rk
  from v_items i left join g_products p on p.product_id = i.product_id) x where rk = 1""",
)
def main_category_by_price(m):
    return marts.top_category(m.fct_items, m.dim_products, ["order_id"]).select("order_id", "main_category")


@query("main_payment", f"select * from {MAIN_PAYMENT} p")
def main_payment(m):
    return marts.main_payment(m.fct_payments)


@query("order_top_payment", "select * from g_paid")
def order_top_payment(m):
    return top_payment(m.fct_payments)


