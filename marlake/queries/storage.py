"""Given tables through CSV files and the lake: written to the query's own scratch folder and read back."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlake.plans import gold
from marlake.queries.registry import query
from marlake.session import scratch_path
from marlake.sources.files import read_raw
from marlake.sources.lake import Lake
from marlake.sources.schemas import RAW_SCHEMAS


def own_lake(m) -> Lake:
    return Lake(m.spark, scratch_path(m.spark, "lake"))


def written_csv(m, table: str, df) -> str:
    path = scratch_path(m.spark, f"csv-{table}")
    names = StructType.fromDDL(RAW_SCHEMAS[table]).names
    df.select(*names).write.options(header=True, escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss").csv(path)
    return path


@query(
    "csv_orders",
    """
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
  order_delivered_customer_date, order_estimated_delivery_date
from v_orders""",
)
def csv_orders(m):
    """Orders as raw CSV files, read by header with typed time stamps."""
    return read_raw(m.spark, "orders", written_csv(m, "orders", m.orders))


@query("load_once_customers", "select customer_id, customer_unique_id, customer_state from v_customers")
def load_once_customers(m):
    """A raw table that is loaded twice keeps its first load."""
    lake, rows = own_lake(m), m.customers.select("customer_id", "customer_unique_id", "customer_state")
    lake.load_once("raw", "customers", rows)
    lake.load_once("raw", "customers", rows.withColumn("customer_state", F.lit("again")))
    return lake.read("raw", "customers")


@query("append_batch_twice", "select seller_id, seller_city, case when seller_id < '5' then 'b1' else 'b2' end batch_id from v_sellers")
def append_batch_twice(m):
    """Two batches, each handed over twice; a batch that is there is not loaded again."""
    lake, rows = own_lake(m), m.sellers.select("seller_id", "seller_city")
    for batch in ("b1", "b2", "b1", "b2"):
        part = rows.where(F.col("seller_id") < "5") if batch == "b1" else rows.where(F.col("seller_id") >= "5")
        lake.append_new_batch("bronze", "sellers", part, batch)
    return lake.read("bronze", "sellers")


@query("rebuild_replaces_table", "select date_day, is_synthetic, order_count from (select cast(date_day as varchar) date_day, is_synthetic, order_count from g_daily) t")
def rebuild_replaces_table(m):
    """A table that is built again shows its latest version only."""
    from marlake.plans.marts import daily_revenue

    lake = own_lake(m)
    daily = daily_revenue(m.order_facts, m.fct_items).select("date_day", "is_synthetic", "order_count")
    lake.publish("gold", "daily", daily.where("is_synthetic"))
    lake.publish("gold", "daily", daily)
    return lake.current("gold", "daily")


@query("empty_scoring_keeps_table", "select order_id, order_status from v_orders where order_status = 'shipped'")
def empty_scoring_keeps_table(m):
    """A scoring run without rows leaves the table of the run before."""
    lake, rows = own_lake(m), m.orders.where("order_status = 'shipped'").select("order_id", "order_status")
    lake.publish_scores("scores", rows)
    lake.publish_scores("scores", rows.where("false"))
    return lake.current("predictions", "scores").drop("scored_at")


SPINE = "(select min(order_purchase_timestamp) a, max(order_purchase_timestamp) b from v_orders)"


@query("date_spine", f"select cast(cast(d as date) as varchar) date_day from {SPINE} s, generate_series(cast(a as date), cast(b as date) - 1, interval 1 day) g(d)")
def date_spine(m):
    """Every day from the first to the last order, the last not included."""
    first, last = m.orders.agg(F.to_date(F.min("order_purchase_timestamp")), F.to_date(F.max("order_purchase_timestamp"))).head()
    return gold.date_spine(m.spark, str(first), str(last))
