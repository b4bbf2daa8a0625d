"""Calendar resampling."""

from pyspark.sql import functions as F

from marlake.plans import replay
from marlake.queries.registry import query
from marlake.queries.views import hashed, normal, uniform

START, END = "1996-01-01", "1998-12-31"
GROWTH_RATE = 1.2

STABLE = f"""(select *, cast(order_purchase_timestamp as date) purchase_date from v_orders
  where cast(order_purchase_timestamp as date) between date '{START}' and date '{END}')"""
BUCKETS = f"""(select month(d) "month", isodow(d) - 1 weekday, list(d order by d) dates
  from (select distinct purchase_date d from {STABLE} s) t group by 1, 2)"""
TARGETS = f"""(select distinct cast(order_purchase_timestamp as date) target_date from v_orders
  where cast(order_purchase_timestamp as date) > date '{END}')"""
DAY = chr(39) + "day" + chr(39)
TEMPLATES = f"""(select target_date, dates[cast(1 + {hashed(DAY, 'cast(target_date as varchar)')} % len(dates) as integer)] template_date
  from (select t.target_date, coalesce(b.dates, f.dates) dates from {TARGETS} t
    left join {BUCKETS} b on b."month" = month(t.target_date) and b.weekday = isodow(t.target_date) - 1
    join (select isodow(d) - 1 weekday, list(d order by d) dates from (select distinct purchase_date d from {STABLE} s) u group by 1) f
      on f.weekday = isodow(t.target_date) - 1) x)"""
REPLAYED = f"(select s.*, t.target_date, 'backfill-' || cast(t.target_date as varchar) new_batch from {STABLE} s join {TEMPLATES} t on t.template_date = s.purchase_date)"


def _id(kind, *parts):
    return f"('synth-' || substr(sha256(concat_ws('|', '{kind}', {', '.join(parts)})), 1, 32))"


JITTER = f"({hashed(chr(39) + 'jitter' + chr(39), 'order_id', 'new_batch', '0')} % 90 - 45)"
SHIFTED = f"""(select {_id('order', 'order_id', 'new_batch', "'0'")} order_id, order_id template_order_id, customer_id template_customer_id, order_status,
  epoch_us(cast(target_date as timestamp)) - epoch_us(cast(purchase_date as timestamp)) + {JITTER} * 60000000 shift_micros,
  order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
  target_date, purchase_date, new_batch batch_id from {REPLAYED} r)"""


def moved(col):
    return f"make_timestamp(epoch_us({col}) + shift_micros) {col}"


def stable(m):
    return replay.stable_orders(m.orders, START, END)


def templates(m):
    targets = (
        m.orders.select(F.to_date("order_purchase_timestamp").alias("target_date"))
        .where(F.col("target_date") > F.lit(END).cast("date"))
        .distinct()
    )
    return replay.template_dates(targets, replay.calendar_buckets(stable(m)))


def new_orders(m):
    return replay.shifted_orders(replay.replayed(stable(m), templates(m)))


@query(
    "stable_window_orders",
    f"""
select 'orders' table_name, count(*) n from {STABLE} s
union all select 'items', count(*) from v_items where order_id in (select order_id from {STABLE} s)
union all select 'payments', count(*) from v_payments where order_id in (select order_id from {STABLE} s)
union all select 'reviews', count(*) from v_reviews where order_id in (select order_id from {STABLE} s)""",
)
def stable_window_orders(m):
    m, orders = m.written(), stable(m)
    kept = {
        "orders": orders,
        "items": replay.of_orders(m.items, orders),
        "payments": replay.of_orders(m.payments, orders),
        "reviews": replay.of_orders(m.reviews, orders),
    }
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n") for n, df in kept.items()]
    first, *rest = counted
    for other in rest:
        first = first.unionByName(other)
    return first


@query(
    "calendar_buckets",
    f"select \"month\", weekday, len(dates) n, array_to_string(cast(dates as varchar[]), ',') dates from {BUCKETS} b",
)
def calendar_buckets(m):
    return replay.calendar_buckets(stable(m)).select(
        "month",
        "weekday",
        F.size("dates").alias("n"),
        F.concat_ws(",", F.transform("dates", lambda d: d.cast("string"))).alias("dates"),
    )


@query(
    "template_dates",
    f"select cast(target_date as varchar) target_date, cast(template_date as varchar) template_date from {TEMPLATES} t",
)
def template_dates(m):
    return templates(m)


@query(
    "replay_orders",
    f"""
select order_id, template_order_id, order_status, {moved('order_purchase_timestamp')}, {moved('order_approved_at')},
  {moved('order_delivered_carrier_date')}, {moved('order_delivered_customer_date')}, {moved('order_estimated_delivery_date')},
  true is_synthetic, cast(purchase_date as varchar) source_template_date, batch_id
from {SHIFTED} s""",
)
def replay_orders(m):
    return new_orders(m).drop("shift_micros", "target_date", "template_customer_id")


@query(
    "replay_hours",
    f"""
select cast(target_date as varchar) target_date, count(*) n from {REPLAYED} r
where hour(order_purchase_timestamp) >= 6 and hour(order_purchase_timestamp) < 12 group by 1""",
)
def replay_hours(m):
    """Only template orders bought from 6 to 12 o'clock."""
    chosen = replay.replayed(stable(m), templates(m), hours=(6, 12))
    return chosen.groupBy("target_date").agg(F.count(F.lit(1)).alias("n"))


def noisy(col, kind, *keys):
    z = normal(chr(39) + kind + chr(39), *keys)
    return f"case when {col} is not null then round(greatest(cast({col} as double) * (1 + {z} * 0.03e0), 0.5e0), 2) end {col}"


@query(
    "replay_items",
    f"""
select order_id, order_item_id, product_id, seller_id, {moved('shipping_limit_date')}, {noisy('price', 'price', 'order_id', 'order_item_id')},
  {noisy('freight_value', 'freight', 'order_id', 'order_item_id')}, true is_synthetic, batch_id
from (select s.order_id, s.shift_micros, s.batch_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value
  from v_items i join {SHIFTED} s on s.template_order_id = i.order_id) t""",
)
def replay_items(m):
    return replay.replayed_items(m.items, new_orders(m))


@query(
    "replay_payments",
    f"""
select order_id, payment_sequential, payment_type, payment_installments, {noisy('payment_value', 'payment', 'order_id', 'payment_sequential')},
  true is_synthetic, batch_id
from (select s.order_id, s.batch_id, p.payment_sequential, p.payment_type, p.payment_installments, p.payment_value
  from v_payments p join {SHIFTED} s on s.template_order_id = p.order_id) t""",
)
def replay_payments(m):
    return replay.replayed_payments(m.payments, new_orders(m))


@query(
    "replay_reviews",
    f"""
select {_id('review', 'review_id', 'order_id')} review_id, order_id, review_score, cast(null as varchar) review_comment_title,
  cast(null as varchar) review_comment_message, {moved('review_creation_date')}, {moved('review_answer_timestamp')}, true is_synthetic, batch_id
from (select s.order_id, s.shift_micros, s.batch_id, r.review_id, r.review_score, r.review_creation_date, r.review_answer_timestamp
  from v_reviews r join {SHIFTED} s on s.template_order_id = r.order_id) t""",
)
def replay_reviews(m):
    return replay.replayed_reviews(m.reviews, new_orders(m))


@query(
    "replay_growth",
    f"""
with r as (select target_date, order_id, row_number() over (partition by target_date order by {hashed("'growth'", 'order_id', 'cast(target_date as varchar)')}, order_id) - 1 k,
    count(*) over (partition by target_date) n from {REPLAYED} r),
w as (select *, greatest(1, round(n * pow({GROWTH_RATE}e0, date_diff('day', date '{END}', target_date) / 365.25e0))) wanted from r),
c as (select *, cast(floor(wanted / n) + case when k < cast(wanted as bigint) % n then 1 else 0 end as integer) copies from w)
select cast(target_date as varchar) target_date, order_id, unnest(generate_series(0, copies - 1)) copy_no from c where copies > 0""",
)
def replay_growth(m):
    grown = replay.grown(replay.replayed(stable(m), templates(m)), GROWTH_RATE, END)
    return grown.select("target_date", "order_id", "copy_no")


POOL = "(select *, row_number() over (order by customer_id) - 1 slot from (select * from v_customers where is_synthetic) x)"


@query(
    "replay_customers",
    f"""
with p as (select * from {POOL} z), n as (select count(*) n from p),
d as (select s.order_id, s.template_customer_id, s.batch_id, case when n.n > 0 and {uniform("'repeat'", 's.order_id')} < 0.0312e0
    then {hashed("'pool'", 's.order_id')} % greatest(n.n, 1) end slot from {SHIFTED} s cross join n)
select d.order_id, case when d.slot is not null then p.customer_id else {_id('customer', 'd.order_id', 'd.batch_id')} end customer_id,
  case when d.slot is not null then p.customer_unique_id else {_id('person', 'd.order_id', 'd.batch_id')} end customer_unique_id,
  case when d.slot is not null then p.customer_zip_code_prefix else coalesce(c.customer_zip_code_prefix, '0') end customer_zip_code_prefix,
  case when d.slot is not null then p.customer_city else coalesce(c.customer_city, 'unknown') end customer_city,
  case when d.slot is not null then p.customer_state else coalesce(c.customer_state, 'NA') end customer_state, d.slot is null is_new_customer
from d left join p on p.slot = d.slot left join v_customers c on c.customer_id = d.template_customer_id""",
)
def replay_customers(m):
    named = replay.with_customers(new_orders(m), m.customers)
    return named.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        "is_new_customer",
    )
