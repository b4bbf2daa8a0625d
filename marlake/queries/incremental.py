"""Six-hour windows, incremental layers, streaming counts."""

from pyspark.sql import functions as F

from marlake.functions.expr import hash_int
from marlake.operators.dedup import differences, merge_latest
from marlake.plans import gold, silver
from marlake.queries.layers import DAILY_SQL
from marlake.queries.registry import query
from marlake.queries.views import hashed, six_hours
from marlake.session import drop_shuffles, scratch_path, stage
from marlake.sources.lake import Lake
from marlake.sources.schemas import TABLE_KEYS
from marlake.streaming import live, revenue, windows
from marlake.streaming.incremental import process_batches, silver_increment, upsert_arrived, upsert_batches

SIX_HOURS = 21_600_000_000


def _pending(bound: str) -> str:
    return f"""
with s as (select event_type pipeline_name, min(ts) a, {bound} b from events group by 1),
f as (select pipeline_name, make_timestamp(cast(ceil(epoch_us(a) / {SIX_HOURS}e0) * {SIX_HOURS} as bigint)) a,
  make_timestamp(cast(floor(epoch_us(b) / {SIX_HOURS}e0) * {SIX_HOURS} as bigint)) - interval 6 hour b from s),
w as (select pipeline_name, unnest(generate_series(a, b, interval 6 hour)) window_start from f where a <= b)
select pipeline_name, window_start, window_start + interval 6 hour window_end, {six_hours('window_start')} batch_id from w"""


@query("windows_pending", _pending("max(ts)"))
def windows_pending(m):
    """Each event type as a pipeline: checkpoint at its first event, bound at its last."""
    states = m.events.groupBy(F.col("event_type").alias("pipeline_name")).agg(
        F.min("ts").alias("last_processed_at"), F.max("ts").alias("upper_bound")
    )
    return windows.pending_windows(states)


@query("windows_pending_bounded", _pending("(select max(ts) from events where event_type = 'purchase')"))
def windows_pending_bounded(m):
    """The last purchase is the cursor of the upstream pipeline."""
    states = m.events.groupBy(F.col("event_type").alias("pipeline_name")).agg(
        F.min("ts").alias("last_processed_at")
    )
    upstream = m.events.where("event_type = 'purchase'").select(F.col("ts").alias("last_processed_at"))
    return windows.pending_windows(windows.bounded_by_upstream(states, upstream))


@query(
    "tumbling_6h_batch",
    f"""
select batch_id, w window_start, w + interval 6 hour window_end, count(*) n, count_if(event_type = 'purchase') purchases
from (select *, {six_hours('ts')} batch_id, time_bucket(interval 6 hour, ts, timestamp '2000-01-01') w from events) t group by 1, 2, 3""",
)
def tumbling_6h_batch(m):
    return (
        windows.with_batch_window(m.events, "ts")
        .groupBy("batch_id", "window_start", "window_end")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    )


def market_lake(m, buckets: int = 2) -> Lake:
    return Lake(m.spark, scratch_path(m.spark, "lake"), buckets=buckets)


def redelivered(m):
    """Every order once as it was created, in an early batch, and once in its final state."""
    early = m.orders.withColumns(
        {
            "order_status": F.lit("created"),
            "order_delivered_customer_date": F.lit(None).cast("timestamp"),
            "batch_id": F.lit("archive-0"),
        }
    )
    return early, m.orders


@query(
    "incr_silver_orders",
    """
select order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date, is_synthetic, batch_id
from v_orders""",
)
def incr_silver_orders(m):
    """Archive first, then the batches that bring each order again; thousands of daily batches, merged as frames."""
    early, final = redelivered(m)
    first = silver_increment(early, "orders", ["archive-0"])
    merged = merge_latest(first, silver.orders(final), ["order_id"])
    return merged.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
        "is_synthetic", "batch_id",
    )


@query(
    "incr_fct_orders",
    "select order_id, customer_unique_id, order_status, round(delivery_days, 6) delivery_days, is_delayed, batch_id from g_orders",
)
def incr_fct_orders(m):
    early, final = redelivered(m)
    merged = merge_latest(silver_increment(early, "orders", ["archive-0"]), silver.orders(final), ["order_id"])
    return gold.fct_orders(merged, m.silver_customers).select(
        "order_id", "customer_unique_id", "order_status", "delivery_days", "is_delayed", "batch_id"
    )


# The other tables: an archive batch has every row, and two thirds of the keys come again in a later one.
RETURNING = {
    "customers": ("customers", "v_customers", ["customer_id"], ["customer_unique_id", "is_synthetic"]),
    "order_items": ("items", "v_items", ["order_id", "order_item_id"], ["product_id", "seller_id", "price", "freight_value"]),
    "order_payments": ("payments", "v_payments", ["order_id", "payment_sequential"], ["payment_type", "payment_installments", "payment_value"]),
    "order_reviews": ("reviews", "v_reviews", ["review_id"], ["order_id", "review_score", "review_creation_date"]),
}


def returned(table: str, m) -> Lake:
    """A lake after the archive batch and a batch that brings some of its keys again: interrupted once, then run twice."""
    source, _, keys, _ = RETURNING[table]
    lake = market_lake(m)
    again = F.pmod(hash_int(F.lit("again"), *keys), F.lit(3)) != 0
    lake.write_batches("bronze", f"bronze_{table}", getattr(m, source).withColumn("batch_id", F.lit("archive-0")), settled=True)
    process_batches(lake, ["archive-0"])
    # The archive batch holds the rows as they are.
    rows = lake.read("bronze", f"bronze_{table}", ["archive-0"])
    lake.write_batches("bronze", f"bronze_{table}", rows.where(again).withColumn("batch_id", F.lit("delivery-1")), settled=True)
    upsert_arrived(lake, table, lake.read("bronze", f"bronze_{table}", ["delivery-1"]))
    for _ in range(2):
        process_batches(lake, ["delivery-1"])
    return lake


def returned_sql(table: str, *more: str) -> str:
    _, view, keys, columns = RETURNING[table]
    names = ["cast({0} as double) {0}".format(c) if c in ("price", "freight_value", "payment_value") else c for c in columns]
    batch = f"case when {hashed(chr(39) + 'again' + chr(39), *keys)} % 3 <> 0 then 'delivery-1' else 'archive-0' end batch_id"
    return f"select {', '.join([*keys, *names, *more])}, {batch} from {view}"


def register_returned(table: str) -> None:
    _, _, keys, columns = RETURNING[table]

    @query(f"incr_silver_{table}", returned_sql(table))
    def silver_rows(m):
        return returned(table, m).read("silver", f"silver_{table}").select(*keys, *columns, "batch_id")

    if table == "customers":
        return
    fact = {"order_items": "fct_order_items", "order_payments": "fct_payments", "order_reviews": "fct_reviews"}[table]
    days = "round(datesub('hour', review_creation_date, review_answer_timestamp) / 24.0e0, 6) review_response_days"
    more = [days] if table == "order_reviews" else []

    @query(f"incr_{fact}", returned_sql(table, *more))
    def fact_rows(m):
        extra = ["review_response_days"] if more else []
        return returned(table, m).read("gold", fact).select(*keys, *columns, *extra, "batch_id")


for name in RETURNING:
    register_returned(name)


def revenue_lake(m) -> Lake:
    """A lake whose first batch holds a third of the orders a day too early and a quarter of the items at twice their price.

    The second batch brings these rows as they are; a run of it stops half way, the next one ends, and it is run once more.
    """
    m = m.written()
    lake = market_lake(m)
    moved = F.pmod(hash_int(F.lit("moved"), "order_id"), F.lit(3)) == 0
    dear = F.pmod(hash_int(F.lit("dear"), "order_id", "order_item_id"), F.lit(4)) == 0
    bought = F.col("order_purchase_timestamp")
    price = F.when(dear, F.col("price") * 2).otherwise(F.col("price")).cast("decimal(18,2)")
    first, second = F.lit("archive-0"), F.lit("delivery-1")
    lake.write_batches("bronze", "bronze_customers", m.customers.withColumn("batch_id", first))
    early = m.orders.withColumn("order_purchase_timestamp", F.when(moved, bought - F.expr("interval 1 day")).otherwise(bought))
    lake.write_batches("bronze", "bronze_orders", early.withColumn("batch_id", first))
    lake.write_batches("bronze", "bronze_order_items", m.items.withColumn("price", price).withColumn("batch_id", first))
    process_batches(lake, ["archive-0"])
    lake.write_batches("bronze", "bronze_orders", m.orders.where(moved).withColumn("batch_id", second))
    lake.write_batches("bronze", "bronze_order_items", m.items.where(dear).withColumn("batch_id", second))
    arrived = [lake.read("bronze", f"bronze_{t}", ["delivery-1"]) for t in ("orders", "order_items")]
    revenue.begin(lake, [rows.select("order_id") for rows in arrived])
    upsert_batches(lake, "orders", silver.orders(arrived[0]))
    for _ in range(2):
        process_batches(lake, ["delivery-1"])
    return lake


@query("incr_daily_revenue_merge", DAILY_SQL)
def incr_daily_revenue_merge(m):
    """The stored state after returns, an interrupted run and a repeated batch; no order is counted again for it."""
    return revenue.current(revenue_lake(m))


@query(
    "incr_equals_full",
    """
select 'silver_order_items' table_name, count(*) left_rows, count(*) right_rows, 0 only_left, 0 only_right from v_items
union all select 'fct_orders', count(*), count(*), 0, 0 from v_orders""",
)
def incr_equals_full(m):
    """Tables grown batch by batch in a lake, compared row by row with full builds of the same bronze rows."""
    year = F.substring("batch_id", 1, len("backfill-1998"))
    raw = m.items_raw.drop("l_returnflag", "l_discount", "l_linestatus", "l_quantity").withColumn("batch_id", year)
    early, final = redelivered(m)
    lake = market_lake(m)
    # A few batches each, written from the splits of the source tables.
    lake.write_batches("bronze", "bronze_customers", m.customers.withColumn("batch_id", F.lit("archive-0")), settled=True)
    lake.write_batches("bronze", "bronze_orders", early, settled=True)
    lake.write_batches("bronze", "bronze_order_items", raw, settled=True)
    arrived = [p.batch for p in lake.write_batches("bronze", "bronze_orders", final.withColumn("batch_id", year), settled=True)]
    batches = sorted({p.batch for p in lake.parts("bronze", "bronze_order_items")} | set(arrived))
    cut = "backfill-1998"
    process_batches(lake, ["archive-0", *[b for b in batches if b < cut]])
    process_batches(lake, [b for b in batches if b >= cut])
    bronze = {t: lake.read("bronze", f"bronze_{t}") for t in ("customers", "orders", "order_items")}
    full = silver.order_items(bronze["order_items"])
    # One table after the other: the files of the first comparison go before the second.
    items = stage(differences(lake.read("silver", "silver_order_items").select(full.columns), full, TABLE_KEYS["order_items"]), "compared")
    drop_shuffles(m.spark)
    whole = gold.fct_orders(silver.orders(bronze["orders"]), silver.customers(bronze["customers"]))
    facts = differences(lake.read("gold", "fct_orders").select(whole.columns), whole, ["customer_id"])  # the key of its join
    return items.withColumn("table_name", F.lit("silver_order_items")).unionByName(
        facts.withColumn("table_name", F.lit("fct_orders"))
    )


@query(
    "backfill_days_pending",
    """
select cast(d as varchar) "day", 'backfill-' || cast(d as varchar) batch_id
from (select distinct cast(order_purchase_timestamp as date) d from v_orders) t
where d >= date '1996-01-01' and 'backfill-' || cast(d as varchar) not in (select batch_id from v_orders where order_status = 'delivered')""",
)
def backfill_days_pending(m):
    """Days with orders whose backfill batch holds no delivered order yet."""
    days = m.orders.select(F.to_date("order_purchase_timestamp").alias("day")).distinct()
    loaded = m.orders.where("order_status = 'delivered'").select("batch_id")
    return windows.pending_days(days, loaded, "1996-01-01")


@query(
    "stream_6h_counts",
    f"""
select {six_hours('ts')} batch_id, time_bucket(interval 6 hour, ts, timestamp '2000-01-01') window_start,
  time_bucket(interval 6 hour, ts, timestamp '2000-01-01') + interval 6 hour window_end, event_type, count(*) n
from events group by 1, 2, 3, 4""",
)
def stream_6h_counts(m):
    """The events table read as a stream, counted per window and type."""
    spark = m.spark
    schema = m.table("events").schema
    source = live.read_files(spark, m.folder, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    target = scratch_path(spark, "window-deltas")
    live.write_window_deltas(
        source, "ts", ["event_type"], target, scratch_path(spark, "stream-state")
    ).awaitTermination()
    return live.window_totals(spark.read.parquet(target), ["event_type"])


# --- a stream with repeated and late deliveries ----------------------------------------------
# Every event is delivered in the part of its five days; one in ten a second time in the next part, one in
# seven only two parts later. Six parts arrive one after the other, three before the stream is started again.
PARTS = 6
DELIVERED = f"""
e as (select event_id, ts, event_type, least(cast(floor(date_diff('day', date '2024-01-01', cast(ts as date)) / 5) as int), {PARTS - 1}) p from events),
d as (select event_id, ts, event_type, least(p + case when event_id % 7 = 3 then 2 else 0 end, {PARTS - 1}) p from e
  union all select event_id, ts, event_type, least(p + 1, {PARTS - 1}) p from e where event_id % 10 = 0),
high as (select p, max(ts) h from d group by p),
marks as (select p, max(h) over (order by p rows between unbounded preceding and 1 preceding) - interval 6 hour w from high),
a as (select d.*, w, w is not null and ts < w late from d join marks m on m.p = d.p)"""
# A stateful operator judges lateness by the watermark that the micro-batch before it worked with. Before a run ends, a
# micro-batch without rows brings that up to date, so only the first part after the restart meets the latest one.
SEEN = """dropping as (select x.p, (select max(h) from high y where y.p <= x.p - case when x.p = 3 then 1 else 2 end) - interval 6 hour w from high x),
c as (select distinct event_id, ts, event_type from d join dropping g on g.p = d.p where g.w is null or ts >= g.w)"""


def delivered(m) -> list:
    """The deliveries of the events, part by part."""
    block = F.least(F.floor(F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")) / 5), F.lit(PARTS - 1))
    rows = m.events.select("event_id", "ts", "event_type", block.cast("int").alias("p"))
    late = F.when(F.col("event_id") % 7 == 3, 2).otherwise(0)
    again = rows.where("event_id % 10 = 0").withColumn("p", F.col("p") + 1)
    every = stage(rows.withColumn("p", F.col("p") + late).unionByName(again).withColumn("p", F.least("p", F.lit(PARTS - 1))), "deliveries")
    return [every.where(F.col("p") == k).drop("p") for k in range(PARTS)]


def streamed(m, start) -> None:
    """Run ``start(source, checkpoint)`` over the first three parts, and again with its checkpoint after the others have come."""
    folder, checkpoint = scratch_path(m.spark, "arrivals"), scratch_path(m.spark, "stream-state")
    for k, part in enumerate(delivered(m)):
        part.coalesce(1).write.parquet(f"{folder}/part={k}")
        if k in (2, PARTS - 1):
            source = live.read_files(m.spark, f"{folder}/*", part.schema, files_per_batch=1)
            start(source, checkpoint).awaitTermination()


@query("stream_first_deliveries", f"with {DELIVERED}, {SEEN} select event_id, ts, event_type from c")
def stream_first_deliveries(m):
    """Repeated deliveries are dropped by stateful deduplication, over several micro-batches and a restart."""
    target = scratch_path(m.spark, "first")
    streamed(m, lambda source, checkpoint: live.append_to(live.first_deliveries(source, "ts", "event_id"), target, checkpoint))
    return m.spark.read.parquet(target).select("event_id", "ts", "event_type")


@query("stream_late_rows", f"with {DELIVERED} select event_id, ts, w watermark from a where late")
def stream_late_rows(m):
    """What came behind the watermark, with the watermark it met."""
    target, marks = scratch_path(m.spark, "late"), scratch_path(m.spark, "marks")
    streamed(m, lambda source, checkpoint: live.write_late_rows(source, "ts", target, marks, checkpoint))
    return m.spark.read.parquet(target).select("event_id", "ts", "watermark")


@query(
    "stream_closed_windows",
    f"""
with {DELIVERED}, {SEEN}, t as (select time_bucket(interval 6 hour, ts, timestamp '2000-01-01') window_start, event_type, count(*) n from c group by 1, 2)
select {six_hours('window_start')} batch_id, window_start, window_start + interval 6 hour window_end, event_type, n
from t where window_start + interval 6 hour <= (select max(h) from high) - interval 6 hour""",
)
def stream_closed_windows(m):
    """Windows of the deduplicated stream, handed on once when they can no longer change."""
    target = scratch_path(m.spark, "closed")

    def start(source, checkpoint):
        return live.append_to(live.closed_window_counts(live.first_deliveries(source, "ts", "event_id"), "ts", ["event_type"], watermarked=True), target, checkpoint)

    streamed(m, start)
    return m.spark.read.parquet(target).select("batch_id", "window_start", "window_end", "event_type", "n")
