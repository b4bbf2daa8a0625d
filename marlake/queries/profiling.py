"""Profiles."""


from pyspark.sql import functions as F

from marlake.plans import profiling
from marlake.queries.registry import query
from marlake.session import stage

DAYS_SQL = """(with n as (select cast(order_purchase_timestamp as date) d, count(*) c from v_orders group by 1)
  select s.d, coalesce(n.c, 0) c from (select cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) d from n) s left join n on n.d = s.d)"""
MONTHS_SQL = """(with n as (select cast(date_trunc('month', order_purchase_timestamp) as date) d, count(*) c from v_orders group by 1)
  select s.d, coalesce(n.c, 0) c from (select cast(unnest(generate_series(min(d), max(d), interval 1 month)) as date) d from n) s left join n on n.d = s.d)"""


@query("daily_volume_filled", f"select cast(d as varchar) \"day\", c orders from {DAYS_SQL} t")
def daily_volume_filled(m):
    return profiling.daily_volume(m.orders)


@query("monthly_volume", f"select cast(d as varchar) \"month\", c orders from {MONTHS_SQL} t")
def monthly_volume(m):
    return profiling.monthly_volume(m.orders)


@query(
    "dow_distribution",
    """
select isodow(order_purchase_timestamp) - 1 weekday, count(*) orders, round(count(*) / (select cast(count(*) as double) from v_orders), 4) "share",
  ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][isodow(order_purchase_timestamp)] "day"
from v_orders group by 1, 4""",
)
def dow_distribution(m):
    return profiling.dow_distribution(m.orders)


@query(
    "hour_distribution",
    """
select hour(order_purchase_timestamp) "hour", count(*) orders, round(count(*) / (select cast(count(*) as double) from v_orders), 4) "share"
from v_orders group by 1""",
)
def hour_distribution(m):
    return profiling.hour_distribution(m.orders)


@query(
    "spike_months",
    f"""
select cast(d as varchar) "month", c orders, round((c - a) / s, 6) z
from {MONTHS_SQL} t cross join (select avg(c) a, stddev_pop(c) s from {MONTHS_SQL} u) k where (c - a) / s >= 0.5""",
)
def spike_months(m):
    return profiling.spike_months(profiling.monthly_volume(m.orders), threshold=0.5)


@query(
    "spike_months_default",
    f"""
select cast(d as varchar) "month", c orders, round((c - a) / s, 6) z
from {MONTHS_SQL} t cross join (select avg(c) a, stddev_pop(c) s from {MONTHS_SQL} u) k where (c - a) / s >= 1.5""",
)
def spike_months_default(m):
    """At the limit that the reports use; the months of these tables may all lie below it."""
    return profiling.spike_months(profiling.monthly_volume(m.orders))


@query(
    "price_sketch_by_day",
    """
select p prob, (select count(*) from v_items) n, (select count(distinct batch_id) from v_items) sketches, 1 within_bound
from (values (0.05), (0.25), (0.5), (0.75), (0.95)) t(p)""",
)
def price_sketch_by_day(m):
    """One stored sketch per day, merged on demand; the exact rank of each quantile is counted and held against the stated error."""
    items = m.items.select("batch_id", F.col("price").cast("double").alias("price"))
    sketches = stage(profiling.sketches_by(items, "batch_id", "price"), "sketches")
    found = stage(profiling.merged_quantiles(sketches, [0.05, 0.25, 0.5, 0.75, 0.95]), "quantiles")
    limits = found.agg(F.collect_list(F.struct("prob", "quantile"))).scalar()
    each = items.select("price").withColumn("q", F.explode(limits)).select("price", "q.*")
    ranks = each.groupBy("prob").agg(
        F.avg((F.col("price") < F.col("quantile")).cast("double")).alias("low"), F.avg((F.col("price") <= F.col("quantile")).cast("double")).alias("high")
    )
    off = F.greatest(F.col("low") - F.col("prob"), F.col("prob") - F.col("high"), F.lit(0.0))
    return found.join(ranks, "prob").select("prob", "n", "sketches", (off <= profiling.SKETCH_ERROR).cast("int").alias("within_bound"))


@query(
    "profile_summary",
    """
select cast(min(cast(order_purchase_timestamp as date)) as varchar) start_day, cast(max(cast(order_purchase_timestamp as date)) as varchar) end_day,
  count(*) total_orders,
  round(count(*) / cast(max(cast(order_purchase_timestamp as date)) - min(cast(order_purchase_timestamp as date)) + 1 as double), 2) avg_orders_per_day,
  count_if(order_purchase_timestamp is null) missing_timestamps
from v_orders""",
)
def profile_summary(m):
    return profiling.order_profile(m.orders)


def _pack(source: str, column: str) -> str:
    x = f"cast({column} as double)"
    return f"""
select round(quantile_cont({x}, 0.25), 6) p25, round(quantile_cont({x}, 0.5), 6) p50, round(quantile_cont({x}, 0.75), 6) p75,
  round(quantile_cont({x}, 0.95), 6) p95, round(cast(sum({column}) as double) / count({column}), 6) mean, round(stddev_samp({x}), 6) std
from {source}"""


@query("price_quantiles", _pack("v_items", "price"))
def price_quantiles(m):
    return profiling.quantile_pack(m.items, "price", digits=6)


@query("freight_quantiles", _pack("v_items", "freight_value"))
def freight_quantiles(m):
    return profiling.quantile_pack(m.items, "freight_value", digits=6)


CATEGORIZED = """(select i.*, coalesce(t.product_category_name_english, p.product_category_name, 'unknown') category
  from v_items i left join v_products p on p.product_id = i.product_id
  left join v_translation t on t.product_category_name = p.product_category_name)"""
TOP15 = f"(select category, count(*) n from {CATEGORIZED} x group by 1 order by 2 desc, 1 limit 15)"


def categorized(m):
    return profiling.items_with_category(m.items, m.products, m.translation)


@query(
    "category_top15",
    f"""
select category, count(*) items, round(quantile_cont(cast(price as double), 0.5), 6) median_price,
  round(cast(sum(price) as double) / count(price), 6) mean_price
from {CATEGORIZED} x where category in (select category from {TOP15} y) group by 1""",
)
def category_top15(m):
    return profiling.category_profile(categorized(m), digits=6)


@query(
    "category_boxstats",
    f"""
select category, round(min(cast(price as double)), 6) low, round(quantile_cont(cast(price as double), 0.25), 6) q1,
  round(quantile_cont(cast(price as double), 0.5), 6) "median", round(quantile_cont(cast(price as double), 0.75), 6) q3,
  round(max(cast(price as double)), 6) high
from {CATEGORIZED} x where category in (select category from {TOP15} y) group by 1""",
)
def category_boxstats(m):
    return profiling.category_boxstats(categorized(m))


@query(
    "hist_clip_p99",
    """
with s as (select cast(price as double) v from v_items), q as (select quantile_cont(v, 0.99) hi, min(v) lo from s)
select cast(least(floor((least(v, hi) - lo) / (hi - lo) * 60), 59) as integer) bin, count(*) n from s cross join q group by 1""",
)
def hist_clip_p99(m):
    return profiling.clipped_histogram(m.items, "price")


def _share(table: str, column: str) -> str:
    return f"select {column}, count(*) n, round(count(*) / (select cast(count(*) as double) from {table}), 4) \"share\" from {table} group by 1"


@query("status_share", _share("v_orders", "order_status"))
def status_share(m):
    return profiling.proportions(m.orders, "order_status")


@query("payment_share", _share("v_payments", "payment_type"))
def payment_share(m):
    return profiling.proportions(m.payments, "payment_type")


@query("score_share", _share("v_reviews", "review_score"))
def score_share(m):
    return profiling.proportions(m.reviews, "review_score")


SCORE_SQL = """
select case when {0} then 'delayed_orders' else 'on_time_orders' end delivery, round(avg(review_score), 2) avg_score, count(*) n
from v_reviews r join v_orders o on o.order_id = r.order_id {1} group by 1"""
LATE = "order_delivered_customer_date > order_estimated_delivery_date"


@query("score_by_delay_parity", SCORE_SQL.format(f"coalesce({LATE}, false)", ""))
def score_by_delay_parity(m):
    """Orders without delivery count as on time."""
    return profiling.score_by_delay(m.reviews, m.orders, parity=True)


@query("score_by_delay", SCORE_SQL.format(LATE, f"where {LATE} is not null"))
def score_by_delay(m):
    return profiling.score_by_delay(m.reviews, m.orders, parity=False)


DONE = """(select (epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000e0 d,
  order_delivered_customer_date > order_estimated_delivery_date late
  from v_orders where order_status = 'delivered' and order_delivered_customer_date is not null and order_estimated_delivery_date is not null
    and order_purchase_timestamp is not null) x"""


@query(
    "delivery_profile",
    _pack(DONE, "d").replace(
        "\nfrom", ", count(*) delivered_orders, round(count_if(late) / count(*), 4) late_share\nfrom", 1
    ),
)
def delivery_profile(m):
    return profiling.delivery_profile(m.orders, digits=6)


@query(
    "repeat_purchase_check",
    """
select count(*) persons, count_if(n = 1) one_time, count_if(n > 1) repeat, round(count_if(n = 1) / count(*), 4) one_time_share,
  abs(round(count_if(n = 1) / count(*), 4) - 0.9688) < 0.01 matches_claim
from (select customer_unique_id, count(distinct order_id) n from g_orders where customer_unique_id is not null group by 1) t""",
)
def repeat_purchase_check(m):
    return profiling.repeat_check(m.orders, m.customers)


