"""Forecasts of many series, with settings whose solution SQL can state."""

from pyspark.sql import functions as F

from marlake.plans import gold, series
from marlake.queries.models import HISTORICAL_END
from marlake.queries.registry import query
from marlake.session import stage

CHOSEN = f"((not o.is_synthetic and cast(o.order_purchase_timestamp as date) <= date '{HISTORICAL_END}') or o.is_synthetic)"
BY_CATEGORY = f"""d as (
  select coalesce(p.product_category_name_english, p.product_category_name, 'unknown') k, cast(o.order_purchase_timestamp as date) ds, cast(sum(i.price) as double) y
  from v_items i join g_orders o on o.order_id = i.order_id join g_products p on p.product_id = i.product_id where {CHOSEN} group by 1, 2)"""
BY_STATE = f"""d as (
  select c.customer_state k, cast(o.order_purchase_timestamp as date) ds, cast(sum(i.price) as double) y
  from v_items i join g_orders o on o.order_id = i.order_id join g_profile c on c.customer_unique_id = o.customer_unique_id where {CHOSEN} group by 1, 2)"""
# Every day from a key's first day to the last day of all keys, in years since the first.
FILLED = """a as (select k, min(ds) a, (select max(ds) from d) b from d group by 1),
s as (select k, a, b, unnest(generate_series(a, b, interval 1 day)) x from a),
f as (select s.k, s.a, s.b, cast(s.x as date) ds, datediff('day', s.a, cast(s.x as date)) / 365.25e0 t, coalesce(d.y, 0e0) y
  from s left join d on d.k is not distinct from s.k and d.ds = cast(s.x as date))"""
LINES = """l as (select k, min(a) a, min(b) b, count(*) as days, coalesce(regr_slope(y, t), 0e0) slope, coalesce(regr_intercept(y, t), avg(y)) base,
  sqrt(greatest(0e0, coalesce((regr_syy(y, t) - regr_slope(y, t) * regr_sxy(y, t)) / count(*), 0e0))) rmse from f group by 1)"""


def rounded(df, columns):
    return df.withColumns({c: F.round(c, 3) for c in columns})


@query(
    "trend_by_category",
    f"with {BY_CATEGORY}, {FILLED}, {LINES} select k category, days, round(base, 3) intercept, round(slope, 3) slope, round(rmse, 3) rmse from l",
)
def trend_by_category(m):
    """Straight line through the daily revenue of every category."""
    daily = series.daily_by_category(m.order_facts, m.fct_items, m.dim_products, HISTORICAL_END)
    rows, inputs = series.inputs_of(stage(series.filled(daily), "series"), None, 0, 0, True)
    fitted = series.fit(rows, inputs).withColumn("slope", F.col("coefficients")[0])
    return rounded(fitted.select(F.col("key").alias("category"), "days", "intercept", "slope", "rmse"), ["intercept", "slope", "rmse"])


@query(
    "forecast_by_category",
    f"""
with {BY_CATEGORY}, {FILLED}, {LINES},
n as (select *, unnest(generate_series(1, 90)) h from l),
p as (select k, b + cast(h as integer) ds, base + slope * datediff('day', a, b + cast(h as integer)) / 365.25e0 v, {series.Z80}e0 * rmse w from n)
select k category, cast(ds as varchar) ds, round(greatest(v, 0e0), 3) yhat, round(greatest(v - w, 0e0), 3) yhat_lower, round(greatest(v + w, 0e0), 3) yhat_upper from p""",
)
def forecast_by_category(m):
    """Next 90 days of every category by its trend."""
    daily = series.daily_by_category(m.order_facts, m.fct_items, m.dim_products, HISTORICAL_END)
    ahead = series.forecast_many(daily, yearly=0, weekly=0)
    return rounded(ahead.withColumnRenamed("key", "category"), ["yhat", "yhat_lower", "yhat_upper"])


@query(
    "forecast_by_state",
    f"""
with {BY_STATE}, {FILLED},
w as (select k, dayofweek(ds) wd, avg(y) v from f group by 1, 2),
e as (select f.k, min(f.b) b, sqrt(avg((f.y - w.v) * (f.y - w.v))) rmse from f join w on w.k is not distinct from f.k and w.wd = dayofweek(f.ds) group by 1),
n as (select *, unnest(generate_series(1, 90)) h from e),
p as (select n.k, n.b + cast(h as integer) ds, w.v, {series.Z80}e0 * n.rmse s from n join w on w.k is not distinct from n.k and w.wd = dayofweek(n.b + cast(h as integer)))
select k state, cast(ds as varchar) ds, round(greatest(v, 0e0), 3) yhat, round(greatest(v - s, 0e0), 3) yhat_lower, round(greatest(v + s, 0e0), 3) yhat_upper from p""",
)
def forecast_by_state(m):
    """Next 90 days of every state by its week: without trend and shrinking, the fit is the mean of the weekday."""
    daily = series.daily_by_state(m.fct_orders, m.fct_items, gold.customer_profile(m.silver_customers), HISTORICAL_END)
    ahead = series.forecast_many(daily, yearly=0, weekly=3, trend=False, ridge=0.0)
    return rounded(ahead.withColumnRenamed("key", "state"), ["yhat", "yhat_lower", "yhat_upper"])
