"""Features, priors and labels."""

from pyspark.sql import functions as F

from marlake.functions.expr import zip_pad
from marlake.operators import priors
from marlake.operators.ewma import prior_ewma
from marlake.plans import features, gold
from marlake.queries.registry import query
from marlake.queries.views import FRACTION, HAVERSINE, ewma_sql
from marlake.session import stage

TIME = features.BY_TIME
W = "rows between unbounded preceding and 1 preceding"


def frames(m) -> dict:
    m = m.written()
    return {
        "orders": m.fct_orders,
        "profiles": gold.customer_profile(m.silver_customers),
        "items": m.fct_items,
        "products": m.dim_products,
        "sellers": m.dim_sellers,
        "payments": m.fct_payments,
        "geolocation": m.dim_geolocation,
        "reviews": m.fct_reviews,
    }


def history(m):
    """All delivered orders with the keys of the rates."""
    delivered = m.fct_orders.where("order_status = 'delivered'")
    return stage(features.delivery_history(delivered, frames(m)), "history")


# --- order features -------------------------------------------------------------------------
@query(
    "order_dominant_item",
    """
select order_id, seller_id, seller_state, seller_zip_code_prefix, main_category, cast(price as double) price,
  cast(freight_value as double) freight_value, n_items, total_weight_g, total_volume_cm3, n_sellers from g_dominant""",
)
def order_dominant_item(m):
    return features.dominant_item(m.fct_items, m.dim_products, m.dim_sellers)


@query(
    "order_totals",
    """
select oi.order_id, cast(sum(oi.price) as double) price, cast(sum(oi.freight_value) as double) freight_value, count(*) n_items,
  sum(pr.product_weight_g) total_weight_g, sum(pr.product_length_cm * pr.product_height_cm * pr.product_width_cm) total_volume_cm3,
  count(distinct oi.seller_id) n_sellers
from v_items oi join g_products pr on pr.product_id = oi.product_id group by 1""",
)
def order_totals(m):
    return features.order_totals(m.fct_items, m.dim_products)


@query(
    "zip_pad",
    """
select customer_id, case when length(customer_zip_code_prefix) < 5 then lpad(customer_zip_code_prefix, 5, '0') else customer_zip_code_prefix end zip
from v_customers""",
)
def zip_pad_query(m):
    return m.customers.select("customer_id", zip_pad("customer_zip_code_prefix").alias("zip"))


@query(
    "seller_customer_distance",
    f"""
select o.order_id, i.seller_id, round({HAVERSINE.format('cg.lat', 'cg.lng', 'sg.lat', 'sg.lng')}, 4) seller_customer_distance_km
from g_orders o join g_profile c on c.customer_unique_id = o.customer_unique_id join g_dominant i on i.order_id = o.order_id
left join g_zip cg on cg.zip = lpad(c.customer_zip_code_prefix, 5, '0') left join g_zip sg on sg.zip = lpad(i.seller_zip_code_prefix, 5, '0')""",
)
def seller_customer_distance(m):
    f = frames(m)
    ends = (
        f["orders"]
        .select("order_id", "customer_unique_id")
        .join(f["profiles"].select("customer_unique_id", "customer_zip_code_prefix"), "customer_unique_id")
        .join(features.dominant_item(f["items"], f["products"], f["sellers"]), "order_id")
    )
    return features.with_distance(ends, f["geolocation"]).select(
        "order_id", "seller_id", F.round("seller_customer_distance_km", 4).alias("seller_customer_distance_km")
    )


@query(
    "order_calendar_features",
    """
select order_id, isodow(order_purchase_timestamp) - 1 purchase_day_of_week, month(order_purchase_timestamp) purchase_month,
  case when month(order_purchase_timestamp) in (11, 12) then 1 else 0 end is_holiday_season from v_orders""",
)
def order_calendar_features(m):
    return features.with_calendar(m.orders.select("order_id", "order_purchase_timestamp")).drop(
        "order_purchase_timestamp"
    )


@query(
    "order_ratio_features",
    f"""
select o.order_id, round(cast(i.f as double) / nullif(cast(i.p as double), 0), 6) freight_ratio,
  round({FRACTION.format('order_purchase_timestamp', 'order_estimated_delivery_date')}, 6) promised_delivery_days
from v_orders o join (select order_id, sum(price) p, sum(freight_value) f from v_items group by 1) i on i.order_id = o.order_id""",
)
def order_ratio_features(m):
    sums = m.items.groupBy("order_id").agg(
        F.sum("price").alias("price"), F.sum("freight_value").alias("freight_value")
    )
    return features.with_ratios(m.orders.join(sums, "order_id")).select(
        "order_id", "freight_ratio", "promised_delivery_days"
    )


@query(
    "delay_magnitude",
    f"""
select order_id, round(coalesce(greatest({FRACTION.format('order_estimated_delivery_date', 'order_delivered_customer_date')}, 0), 0), 6) delay_magnitude_days
from v_orders""",
)
def delay_magnitude(m):
    return m.orders.select("order_id", features.delay_magnitude().alias("delay_magnitude_days"))


# --- priors ---------------------------------------------------------------------------------
KNOWN = "(select * from g_history where x is not null)"


def known(m):
    return history(m).where("is_delayed_num is not null")


@query(
    "global_prior_rate",
    f"""
select order_id, round(coalesce(avg(x) over (order by order_purchase_timestamp, order_id {W}), (select avg(x) from {KNOWN} k)), 6) global_prior
from {KNOWN} t""",
)
def global_prior_rate(m):
    rows = known(m).select(*TIME, "is_delayed_num")
    return priors.global_prior(rows, TIME, "is_delayed_num", "global_prior").select("order_id", "global_prior")


@query(
    "expanding_prior_rate",
    f"""
select order_id, main_category, round(coalesce(case when main_category is not null then avg(x) over (partition by main_category order by order_purchase_timestamp, order_id {W}) end,
  avg(x) over (order by order_purchase_timestamp, order_id {W}), (select avg(x) from {KNOWN} k)), 6) category_prior_delay_rate
from {KNOWN} t""",
)
def expanding_prior_rate(m):
    rows = known(m).select(*TIME, "main_category", "is_delayed_num")
    seen = priors.global_prior(rows, TIME, "is_delayed_num", "global_prior")
    out = priors.expanding_prior(
        seen, "main_category", TIME, "is_delayed_num", "category_prior_delay_rate", "global_prior"
    )
    return out.select("order_id", "main_category", "category_prior_delay_rate")


@query(
    "route_prior_shrunk",
    f"""
with g as (select *, coalesce(avg(x) over (order by order_purchase_timestamp, order_id {W}), (select avg(x) from {KNOWN} k)) gp,
  avg(x) over (partition by state_pair order by order_purchase_timestamp, order_id {W}) m,
  count(x) over (partition by state_pair order by order_purchase_timestamp, order_id {W}) n from {KNOWN} t)
select order_id, state_pair, round((coalesce(m, gp) * n + gp * 15) / (n + 15), 6) seller_state_to_customer_state from g""",
)
def route_prior_shrunk(m):
    rows = known(m).select(*TIME, "state_pair", "is_delayed_num")
    seen = priors.global_prior(rows, TIME, "is_delayed_num", "global_prior")
    out = priors.shrunken_prior(
        seen, "state_pair", TIME, "is_delayed_num", "seller_state_to_customer_state", "global_prior"
    )
    return out.select("order_id", "state_pair", "seller_state_to_customer_state")


EWMA = ewma_sql("g_history")


@query("seller_ewma_prior", f"select order_id, seller_id, round(ewma, 6) ewma from {EWMA} t")
def seller_ewma_prior(m):
    """Delivered orders without a delay flag stay in as gaps."""
    rows = history(m).select("seller_id", *TIME, "is_delayed_num")
    return prior_ewma(rows, ["seller_id"], TIME, "is_delayed_num", "ewma").select("order_id", "seller_id", "ewma")


@query(
    "seller_ewma_current",
    f"""
select seller_id, round(max(case when rn = 1 then ewma end), 6) seller_rate
from (select seller_id, ewma, row_number() over (partition by seller_id order by ewma is null, i desc) rn from {EWMA} t) x group by 1""",
)
def seller_ewma_current(m):
    rows = history(m).select("seller_id", *TIME, "is_delayed_num")
    return features.current_ewma(prior_ewma(rows, ["seller_id"], TIME, "is_delayed_num", "ewma"))


@query(
    "current_rates",
    """
select 'category' kind, main_category name, round(avg(x), 6) rate, round(avg(promised), 6) promised from g_history where main_category is not null group by 2
union all select 'state', customer_state, round(avg(x), 6), cast(null as double) from g_history group by 2""",
)
def current_rates(m):
    rows = history(m)
    category = priors.current_rate(rows, "main_category", "is_delayed_num", "rate").join(
        priors.current_rate(rows, "main_category", "promised_delivery_days", "promised"), "main_category"
    )
    state = priors.current_rate(rows, "customer_state", "is_delayed_num", "rate")
    return category.select(F.lit("category").alias("kind"), F.col("main_category").alias("name"), "rate", "promised").unionByName(
        state.select(F.lit("state").alias("kind"), F.col("customer_state").alias("name"), "rate"),
        allowMissingColumns=True,
    )


@query(
    "route_rate_shrunk",
    """
select state_pair, round((avg(x) * count(x) + (select avg(x) from g_history) * 15) / (count(x) + 15), 6) route_rate from g_history group by 1""",
)
def route_rate_shrunk(m):
    return features.current_rates(history(m))["route"]


# --- customers, labels, selections ----------------------------------------------------------
FIRST = """(select o.order_id, o.customer_unique_id from g_orders o join (select customer_unique_id, min(order_purchase_timestamp) t
  from g_orders group by 1) f on f.customer_unique_id = o.customer_unique_id and f.t = o.order_purchase_timestamp)"""
FIRST_SQL = f"""
select g.*, p.payment_type, p.payment_installments from (
  select f.customer_unique_id, cast(sum(i.price) as double) first_order_price, cast(sum(i.freight_value) as double) first_order_freight,
    count(*) first_order_n_items, count(distinct i.seller_id) first_order_n_sellers, sum(pr.product_weight_g) first_order_weight,
    max(case when i.rk = 1 then pr.product_category_name_english end) first_order_main_category
  from {FIRST} f join (select i.*, row_number() over (partition by f.customer_unique_id order by i.price desc, i.order_id desc, i.order_item_id desc) rk
    from v_items i join {FIRST} f on f.order_id = i.order_id) i on i.order_id = f.order_id
  join g_products pr on pr.product_id = i.product_id group by 1) g
left join (select customer_unique_id, payment_type, payment_installments from (select f.customer_unique_id, p.*,
    row_number() over (partition by f.customer_unique_id order by p.order_id, p.payment_sequential) rn
    from v_payments p join {FIRST} f on f.order_id = p.order_id) x where rn = 1) p on p.customer_unique_id = g.customer_unique_id"""


@query("first_order_features", FIRST_SQL)
def first_order_features(m):
    m = m.written()
    return features.first_order_features(m.fct_orders, m.fct_items, m.dim_products, m.fct_payments)


@query(
    "incremental_clv",
    f"""
with f as (select f.customer_unique_id, f.order_id, sum(i.price) p, sum(i.freight_value) fr from {FIRST} f join v_items i on i.order_id = f.order_id
  join g_products pr on pr.product_id = i.product_id group by 1, 2),
t as (select o.customer_unique_id, sum(i.price) + sum(i.freight_value) total from g_orders o join v_items i on i.order_id = o.order_id group by 1)
select f.customer_unique_id, f.order_id, c.customer_state, cast(t.total as double) total_clv,
  greatest(cast(t.total - f.p - f.fr as double), 0) incremental_clv, round(ln(1 + greatest(cast(t.total - f.p - f.fr as double), 0)), 6) log_incremental_clv
from f join t on t.customer_unique_id = f.customer_unique_id join g_profile c on c.customer_unique_id = f.customer_unique_id""",
)
def incremental_clv(m):
    f = frames(m)
    out = features.incremental_value(f["orders"], f["profiles"], f["items"], f["products"], f["payments"])
    return out.select(
        "customer_unique_id", "order_id", "customer_state", "total_clv", "incremental_clv", "log_incremental_clv"
    )


@query(
    "impute_median",
    """
select order_id, round(coalesce(delivery_days, (select quantile_cont(delivery_days, 0.5) from g_orders)), 6) delivery_days from g_orders""",
)
def impute_median(m):
    return features.impute(m.order_facts.select("order_id", "delivery_days"), "delivery_days")


@query(
    "negative_review_label",
    "select review_id, review_score, cast(review_score <= 2 as int) negative_review from v_reviews",
)
def negative_review_label(m):
    return m.reviews.select("review_id", "review_score", features.negative_review().alias("negative_review"))


@query(
    "label_balance",
    """
select cast(review_score <= 2 as int) negative_review, count(*) n, round(count(*) / (select cast(count(*) as double) from v_reviews), 6) "share"
from v_reviews group by 1""",
)
def label_balance(m):
    return features.label_balance(m.reviews.select(features.negative_review().alias("negative_review")), "negative_review")


@query(
    "delivered_without_review",
    "select order_id, order_purchase_timestamp from g_orders where order_status = 'delivered' and order_id not in (select order_id from v_reviews)",
)
def delivered_without_review(m):
    return features.delivered_without_review(m.order_facts, m.fct_reviews).select(
        "order_id", "order_purchase_timestamp"
    )


@query("open_orders", "select order_id, order_status from g_orders where order_status not in ('delivered', 'canceled')")
def open_orders(m):
    return features.open_orders(m.order_facts).select("order_id", "order_status")


# --- feature frames -------------------------------------------------------------------------
PLAIN = [
    "n_items", "payment_installments", "purchase_day_of_week", "purchase_month", "n_sellers", "is_holiday_season",
    "main_category", "payment_type", "seller_state",
]
ROUNDED = [c for c in features.DELIVERY_NUMERIC if c not in PLAIN]


def _select(prefix: str = "") -> str:
    cols = ["order_id", *[c for c in PLAIN], *[f"round({c}, 6) {c}" for c in ROUNDED]]
    return prefix + ", ".join(cols)


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


@query(
    "delivery_features",
    f"""
with k as (select *, is_delayed_num x from g_known),
a as (select k.*, coalesce(e.ewma, (select avg(x) from k)) seller_ewma_delay_rate,
  coalesce(avg(x) over (order by order_purchase_timestamp, k.order_id {W}), (select avg(x) from k)) gp,
  case when main_category is not null then avg(x) over (partition by main_category order by order_purchase_timestamp, k.order_id {W}) end cp,
  case when main_category is not null then avg(promised_delivery_days) over (partition by main_category order by order_purchase_timestamp, k.order_id {W}) end pp,
  avg(x) over (partition by customer_state order by order_purchase_timestamp, k.order_id {W}) sp,
  avg(x) over (partition by state_pair order by order_purchase_timestamp, k.order_id {W}) rp,
  count(x) over (partition by state_pair order by order_purchase_timestamp, k.order_id {W}) rn
  from k join {ewma_sql("(select *, is_delayed_num x from g_known)")} e on e.order_id = k.order_id),
b as (select *, coalesce(cp, gp) category_prior_delay_rate, coalesce(sp, gp) customer_state_prior_delay_rate,
  promised_delivery_days - coalesce(pp, (select avg(promised_delivery_days) from k)) promised_vs_category_typical,
  (coalesce(rp, gp) * rn + gp * 15) / (rn + 15) seller_state_to_customer_state from a)
select {_select()} from b""",
)
def delivery_features(m):
    """Training frame: point-in-time rates of delivered historical orders."""
    out = features.delivery_features(frames(m), training=True)
    return rounded(out.select("order_id", *PLAIN, *ROUNDED), ROUNDED)


@query(
    "delivery_features_open",
    f"""
with h as (select * from g_history), k as (select * from g_delivery where is_synthetic and order_status not in ('delivered', 'canceled')),
e as (select seller_id, max(case when rn = 1 then ewma end) r
  from (select seller_id, ewma, row_number() over (partition by seller_id order by ewma is null, i desc) rn from {EWMA} t) x group by 1),
c as (select main_category, avg(x) r, avg(promised) p from h where main_category is not null group by 1), s as (select customer_state, avg(x) r from h group by 1),
ro as (select state_pair, (avg(x) * count(x) + (select avg(x) from h) * 15) / (count(x) + 15) r from h group by 1),
b as (select k.*, coalesce(e.r, (select avg(x) from h)) seller_ewma_delay_rate, coalesce(c.r, (select avg(x) from h)) category_prior_delay_rate,
  coalesce(s.r, (select avg(x) from h)) customer_state_prior_delay_rate,
  promised_delivery_days - coalesce(c.p, (select avg(promised_delivery_days) from k)) promised_vs_category_typical,
  coalesce(ro.r, (select avg(x) from h)) seller_state_to_customer_state
  from k left join e on e.seller_id = k.seller_id left join c on c.main_category = k.main_category
  left join s on s.customer_state = k.customer_state left join ro on ro.state_pair = k.state_pair)
select {_select()} from b""",
)
def delivery_features_open(m):
    """Scoring frame: open synthetic orders with present rates."""
    out = features.delivery_features(frames(m), training=False)
    return rounded(out.select("order_id", *PLAIN, *ROUNDED), ROUNDED)


REVIEW_BASE = f"""
select o.order_id, o.order_purchase_timestamp, i.seller_id, i.main_category, p.payment_type, cast(i.price as double) price,
  cast(i.freight_value as double) freight_value, i.n_items, i.n_sellers, i.total_weight_g, i.total_volume_cm3, o.delivery_days,
  cast(cast(o.is_delayed as int) as double) x, {FRACTION.format('o.order_purchase_timestamp', 'o.order_estimated_delivery_date')} promised_delivery_days,
  coalesce(greatest({FRACTION.format('o.order_estimated_delivery_date', 'o.order_delivered_customer_date')}, 0), 0) delay_magnitude_days"""
REVIEW_COLS = """seller_id, main_category, payment_type, price, freight_value, n_items, n_sellers, total_weight_g, total_volume_cm3,
  round(coalesce(delivery_days, (select quantile_cont(delivery_days, 0.5) from b)), 6) delivery_days, x is_delayed_num,
  round(promised_delivery_days, 6) promised_delivery_days, round(delay_magnitude_days, 6) delay_magnitude_days, round(x * price, 6) is_delayed_x_price"""
REVIEW_OUT = [
    "order_id", "seller_id", "main_category", "payment_type", "price", "freight_value", "n_items", "n_sellers", "total_weight_g",
    "total_volume_cm3", "delivery_days", "is_delayed_num", "promised_delivery_days", "delay_magnitude_days",
    "is_delayed_x_price", "seller_ewma_delay_rate",
]
REVIEW_ROUND = [
    "delivery_days", "promised_delivery_days", "delay_magnitude_days", "is_delayed_x_price", "seller_ewma_delay_rate",
]


@query(
    "review_features",
    f"""
with b as materialized ({REVIEW_BASE}, r.review_id, cast(r.review_score <= 2 as int) negative_review
  from g_orders o join g_best i on i.order_id = o.order_id join g_paid p on p.order_id = o.order_id
  join v_reviews r on r.order_id = o.order_id where not o.is_synthetic)
select b.order_id, b.review_id, b.negative_review, b.{REVIEW_COLS}, round(coalesce(e.ewma, (select avg(x) from b)), 6) seller_ewma_delay_rate
from b join {ewma_sql("b", order="order_purchase_timestamp, order_id, review_id", key="review_id")} e on e.review_id = b.review_id""",
)
def review_features(m):
    """Training frame: one row per review of a historical order."""
    out = features.review_features(frames(m), training=True)
    return rounded(out.select("review_id", "negative_review", *REVIEW_OUT), REVIEW_ROUND)


@query(
    "review_features_pending",
    f"""
with h as materialized (select o.order_id, o.order_purchase_timestamp, cast(cast(o.is_delayed as int) as double) x, i.seller_id
  from g_orders o join g_best i on i.order_id = o.order_id where o.order_status = 'delivered'),
e as (select seller_id, max(case when rn = 1 then ewma end) r
  from (select seller_id, ewma, row_number() over (partition by seller_id order by ewma is null, i desc) rn from {ewma_sql("h")} t) x group by 1),
b as ({REVIEW_BASE} from g_orders o join g_best i on i.order_id = o.order_id join g_paid p on p.order_id = o.order_id
  where o.is_synthetic and o.order_status = 'delivered' and o.order_id not in (select order_id from v_reviews))
select b.order_id, b.{REVIEW_COLS}, round(coalesce(e.r, (select avg(x) from h)), 6) seller_ewma_delay_rate
from b left join e on e.seller_id = b.seller_id""",
)
def review_features_pending(m):
    """Scoring frame: delivered synthetic orders without review."""
    out = features.review_features(frames(m), training=False)
    return rounded(out.select(*REVIEW_OUT), REVIEW_ROUND)
