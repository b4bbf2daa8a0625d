"""Dashboard reads."""

from pyspark.sql import functions as F

from marlake.plans import features, gold, reports, scoring
from marlake.queries.registry import query
from marlake.session import scratch_path, stage
from marlake.sources.lake import Lake

AS_OF = "2001-08-01"


@query(
    "kpi_overview",
    f"""
with t as (
  select (select sum(price) + sum(freight_value) from v_items i join g_orders o on o.order_id = i.order_id
          where o.is_synthetic and cast(o.order_purchase_timestamp as date) = date '{AS_OF}') revenue_today,
    (select count(distinct order_id) from g_orders where is_synthetic and cast(order_purchase_timestamp as date) = date '{AS_OF}') orders_today,
    (select sum(price) + sum(freight_value) from v_items i join g_orders o on o.order_id = i.order_id
          where o.is_synthetic and cast(o.order_purchase_timestamp as date) = date '{AS_OF}' - 1) revenue_yesterday,
    (select count(distinct order_id) from g_orders where is_synthetic and cast(order_purchase_timestamp as date) = date '{AS_OF}' - 1) orders_yesterday)
select cast(revenue_today as double) revenue_today, orders_today, cast(revenue_yesterday as double) revenue_yesterday, orders_yesterday,
  round((cast(revenue_today as double) - cast(revenue_yesterday as double)) / nullif(cast(revenue_yesterday as double), 0), 6) revenue_change,
  round((orders_today - orders_yesterday) / nullif(cast(orders_yesterday as double), 0), 6) orders_change
from t""",
)
def kpi_overview(m):
    return reports.kpi_overview(m.order_facts, m.fct_items, AS_OF)


TREND_SQL = f"""
select cast(date_day as varchar) ds, order_count orders, cast(total_revenue as double) revenue{{0}} from g_daily
where is_synthetic and date_day >= date '{AS_OF}' - 90"""


@query("trend_90d", TREND_SQL.format(""))
def trend_90d(m):
    return reports.trend(m.mart_daily_revenue, AS_OF)


@query(
    "trend_with_forecast",
    TREND_SQL.format(", cast(null as double) yhat, cast(null as double) yhat_lower, cast(null as double) yhat_upper")
    + f"""
union all select cast(date_day + 91 as varchar), null, null, cast(total_revenue as double),
  round(cast(total_revenue as double) * 0.8e0, 6), round(cast(total_revenue as double) * 1.2e0, 6)
from g_daily where is_synthetic and date_day >= date '{AS_OF}' - 90""",
)
def trend_with_forecast(m):
    """The last 90 days followed by a forecast table that repeats them."""
    actual = reports.trend(m.mart_daily_revenue, AS_OF)
    y = F.col("revenue").cast("double")
    forecast = actual.select(
        F.date_add("ds", 91).alias("ds"), y.alias("yhat"), (y * 0.8).alias("yhat_lower"), (y * 1.2).alias("yhat_upper")
    )
    return reports.trend_with_forecast(actual, forecast)


CATEGORY_SQL = """
select coalesce(p.product_category_name_english, p.product_category_name, 'unknown') category,
  cast(sum(i.price) + sum(i.freight_value) as double) revenue, count(distinct i.order_id) orders
from v_items i join g_orders o on o.order_id = i.order_id join g_products p on p.product_id = i.product_id
where o.is_synthetic group by 1"""


@query("revenue_by_category", CATEGORY_SQL + " order by 2 desc, 1 limit 10")
def revenue_by_category(m):
    return reports.revenue_by_category(m.order_facts, m.fct_items, m.dim_products)


@query(
    "revenue_by_state",
    """
select c.customer_state state, cast(sum(i.price) + sum(i.freight_value) as double) revenue, count(distinct o.order_id) orders
from g_orders o join v_items i on i.order_id = o.order_id join g_profile c on c.customer_unique_id = o.customer_unique_id
where o.is_synthetic group by 1""",
)
def revenue_by_state(m):
    return reports.revenue_by_state(m.fct_orders, m.fct_items, gold.customer_profile(m.silver_customers))


DELIVERY_SQL = """
select {0}, count(*) delivered_orders, round(count_if(not is_delayed) / count(*), 6) on_time_rate, round(sum(delivery_days) / count(*), 6) avg_delivery_days
from g_orders where is_synthetic and order_status = 'delivered' and is_delayed is not null {1} group by 1"""
DAY = "cast(cast(order_purchase_timestamp as date) as varchar) ds"
WEEK = (
    "cast(cast(order_purchase_timestamp as date) - cast(dayofweek(order_purchase_timestamp) as integer) as varchar) week_start"
)
LAST_90 = f"and cast(order_purchase_timestamp as date) >= date '{AS_OF}' - 90"


@query("delivery_daily", DELIVERY_SQL.format(DAY, LAST_90))
def delivery_daily(m):
    return reports.delivery_performance(m.order_facts, "day", AS_OF)


@query("delivery_weekly", DELIVERY_SQL.format(WEEK, ""))
def delivery_weekly(m):
    return reports.delivery_performance(m.order_facts, "week")


REVIEW_SQL = """
select {0}, round(avg(review_score), 6) avg_score, round(count_if(review_score <= 2) / count(*), 6) negative_rate, count(*) n_reviews
from g_reviews r join g_orders o on o.order_id = r.order_id where o.is_synthetic {1} group by 1"""


@query("reviews_daily", REVIEW_SQL.format(DAY, LAST_90))
def reviews_daily(m):
    return reports.review_trend(m.order_facts, m.fct_reviews, "day", AS_OF)


@query("reviews_weekly", REVIEW_SQL.format(WEEK, ""))
def reviews_weekly(m):
    return reports.review_trend(m.order_facts, m.fct_reviews, "week")


# --- lists over scoring tables --------------------------------------------------------------
TIERS_SQL = """(select order_id, risk_score, case when s <= 0.5 then 'Low' when s <= 0.8 then 'Medium' when s <= 0.95 then 'High' else 'Critical' end risk_tier
  from (select order_id, cast(order_payment_value as double) risk_score,
          percent_rank() over (order by cast(order_payment_value as double), order_id) s from g_values) t)"""


def tiered(m):
    """Order value as the score of a risk table."""
    values = gold.order_values(m.silver_orders, m.silver_customers, m.silver_payments)
    scores = values.select("order_id", F.col("order_payment_value").cast("double").alias("risk_score"))
    return scoring.risk_tiers(scores, "risk_score", "order_id")


@query("risk_tiers", f"select * from {TIERS_SQL} t")
def risk_tiers(m):
    return tiered(m)


@query("risk_list", f"select * from {TIERS_SQL} t where risk_tier = 'Critical' order by risk_score desc, order_id limit 200")
def risk_list(m):
    return reports.top_list(tiered(m), "risk_score", "order_id", "risk_tier", "Critical")


@query(
    "risk_summary",
    f"""
select risk_tier, count(*) n, case risk_tier when 'Critical' then 1 when 'High' then 2 when 'Medium' then 3 else 4 end tier_rank
from {TIERS_SQL} t group by risk_tier""",
)
def risk_summary(m):
    return reports.tier_summary(tiered(m))


ACTIONS_SQL = f"""(with s as (
  select customer_unique_id, customer_state, cast(monetary as double) predicted_incremental_value,
    case when segment_label = 'lost' and frequency > 10 then 'Lapsed & High-Value' when segment_label = 'lost' then 'Lapsed & Low-Value'
         when frequency > 10 then 'Recent & High-Value' else 'Recent & Modest-Spend' end segment
  from g_dim_customers),
 q as (select quantile_cont(predicted_incremental_value, 0.33) p33, quantile_cont(predicted_incremental_value, 0.66) p66 from s)
 select s.*, case when segment in ('{scoring.LAPSED[0]}', '{scoring.LAPSED[1]}') and predicted_incremental_value >= p66 then '{scoring.ACTION_VOUCHER}'
   when segment = '{scoring.LAPSED[0]}' then '{scoring.ACTION_WIN_BACK}'
   when segment in ('{scoring.LAPSED[0]}', '{scoring.LAPSED[1]}') and predicted_incremental_value <= p33 then '{scoring.ACTION_EMAIL}'
   else '{scoring.ACTION_NONE}' end suggested_action
 from s cross join q)"""


def actions(m):
    """Segments from recency label and frequency, spend as the predicted value."""
    lost, often = F.col("segment_label") == "lost", F.col("frequency") > 10
    segment = (
        F.when(lost & often, "Lapsed & High-Value")
        .when(lost, "Lapsed & Low-Value")
        .when(often, "Recent & High-Value")
        .otherwise("Recent & Modest-Spend")
    )
    base = m.dim_customers.select(
        "customer_unique_id",
        "customer_state",
        F.col("monetary").cast("double").alias("predicted_incremental_value"),
        segment.alias("segment"),
    )
    return scoring.suggested_action(base)


@query("suggested_action", f"select * replace (round(predicted_incremental_value, 6) as predicted_incremental_value) from {ACTIONS_SQL} t")
def suggested_action(m):
    return actions(m)


@query(
    "customer_actions_list",
    f"""
select * from {ACTIONS_SQL} t where suggested_action = '{scoring.ACTION_VOUCHER}'
order by predicted_incremental_value desc, customer_unique_id limit 200""",
)
def customer_actions_list(m):
    return reports.top_list(
        actions(m), "predicted_incremental_value", "customer_unique_id", "suggested_action", scoring.ACTION_VOUCHER
    )


@query("customer_actions_summary", f"select suggested_action, count(*) n from {ACTIONS_SQL} t group by 1")
def customer_actions_summary(m):
    return reports.label_counts(actions(m), "suggested_action")


# (order, seller) grain, synthetic cohort; {0} filters, parity joins items x reviews.
SELLER_CORRECT = """(
select i.order_id, i.seller_id, i.price, 1 w, 1 wr, o.order_purchase_timestamp ts, cast(o.is_delayed as int) late, r.s score_sum, r.n score_n
from (select order_id, seller_id, sum(price) price from v_items group by 1, 2) i
join g_orders o on o.order_id = i.order_id and o.is_synthetic
left join (select order_id, sum(review_score) s, count(review_score) n from v_reviews group by 1) r on r.order_id = i.order_id)"""
SELLER_PARITY = """(
select i.order_id, i.seller_id, i.price, o.order_purchase_timestamp ts, cast(o.is_delayed as int) late, r.review_score score
from v_items i join g_orders o on o.order_id = i.order_id and o.is_synthetic left join v_reviews r on r.order_id = i.order_id)"""


def _stats(body: str) -> str:
    return f"""
with s as ({body}),
g as (select sum(delay_rate_raw * n_orders) / sum(case when delay_rate_raw is null then n_orders else n_orders end) d, sum(review_raw * n_orders) / sum(n_orders) r from s)
select seller_id, n_orders, cast(revenue as double) revenue, round(delay_rate_raw, 6) delay_rate_raw, round(review_raw, 6) review_raw,
  round((delay_rate_raw * n_orders + d * 10) / (n_orders + 10), 6) delay_rate, round((review_raw * n_orders + r * 10) / (n_orders + 10), 6) review_score,
  round(ln(1 + cast(revenue as double)), 6) revenue_log, round(ln(1 + n_orders), 6) n_orders_log
from s cross join g"""


def sold(m):
    return features.seller_orders(m.order_facts.where("is_synthetic"), m.fct_items, m.fct_reviews)


STATS_SQL = _stats(
    "select seller_id, count(*) n_orders, sum(price) revenue, avg(late) delay_rate_raw, sum(score_sum) / cast(sum(score_n) as double) review_raw"
    f" from {SELLER_CORRECT} t group by 1"
)


@query("seller_lifetime_stats", STATS_SQL)
def seller_lifetime_stats(m):
    return features.seller_lifetime_stats(sold(m))


@query(
    "seller_lifetime_stats_parity",
    _stats(
        "select seller_id, count(distinct order_id) n_orders, sum(price) revenue, avg(late) delay_rate_raw, avg(score) review_raw"
        f" from {SELLER_PARITY} t group by 1"
    ),
)
def seller_lifetime_stats_parity(m):
    return features.seller_lifetime_stats(sold(m), parity=True)


def _windows(source: str, review: str) -> str:
    today, week = f"cast(ts as date) = date '{AS_OF}'", f"cast(ts as date) >= date '{AS_OF}' - 7"
    return f"""
select seller_id, count_if({today}) orders_today, cast(sum(case when {today} then price else 0 end) as double) revenue_today,
  round(avg(case when {today} then late end), 6) delay_rate_today, count_if({week}) orders_this_week,
  cast(sum(case when {week} then price else 0 end) as double) revenue_this_week,
  round(avg(case when {week} then late end), 6) delay_rate_this_week, round({review.format(week)}, 6) review_score_this_week
from {source} t group by seller_id"""


WINDOWS_SQL = _windows(
    SELLER_CORRECT, "sum(case when {0} then score_sum end) / cast(sum(case when {0} then score_n end) as double)"
)


@query("seller_window_metrics", WINDOWS_SQL)
def seller_window_metrics(m):
    return features.seller_window_metrics(sold(m), AS_OF)


@query("seller_window_metrics_parity", _windows(SELLER_PARITY, "avg(case when {0} then score end)"))
def seller_window_metrics_parity(m):
    return features.seller_window_metrics(sold(m), AS_OF, parity=True)


@query("seller_list", f"select * from ({WINDOWS_SQL}) w order by revenue_this_week desc, seller_id limit 200")
def seller_list(m):
    return reports.top_list(features.seller_window_metrics(sold(m), AS_OF), "revenue_this_week", "seller_id")


def scored_lake(m) -> Lake:
    """A lake with two runs of the scoring tables; the first one scored everything the other way round."""
    lake = Lake(m.spark, scratch_path(m.spark, "lake"))
    risk, acts = stage(tiered(m), "tiers"), stage(actions(m), "actions")
    sellers = stage(features.seller_window_metrics(sold(m), AS_OF), "sellers")
    wrong = risk.withColumns({"risk_score": -F.col("risk_score"), "risk_tier": F.lit("Critical")})
    for tiers, chosen in ((wrong, acts.withColumn("suggested_action", F.lit(scoring.ACTION_VOUCHER))), (risk, acts)):
        lake.publish_scores("predictions_delivery_risk", tiers)
        lake.publish_scores("predictions_customer_actions", chosen)
        lake.publish_scores("predictions_seller_segments", sellers)
    return lake


@query("stored_risk_list", f"select * from {TIERS_SQL} t where risk_tier = 'Critical' order by risk_score desc, order_id limit 200")
def stored_risk_list(m):
    return reports.stored_list(scored_lake(m), "predictions_delivery_risk", "risk_score", "order_id", "risk_tier", "Critical")


@query("stored_actions_summary", f"select suggested_action, count(*) n from {ACTIONS_SQL} t group by 1")
def stored_actions_summary(m):
    return reports.stored_counts(scored_lake(m), "predictions_customer_actions", "suggested_action")


@query("stored_seller_list", f"select * from ({WINDOWS_SQL}) w order by revenue_this_week desc, seller_id limit 200")
def stored_seller_list(m):
    return reports.stored_list(scored_lake(m), "predictions_seller_segments", "revenue_this_week", "seller_id")


@query("trend_without_forecast", TREND_SQL.format(", cast(null as double) yhat, cast(null as double) yhat_lower, cast(null as double) yhat_upper"))
def trend_without_forecast(m):
    """Where no forecast has been published, the trend stands alone."""
    lake = Lake(m.spark, scratch_path(m.spark, "lake"))
    return reports.trend_with_forecast(reports.trend(m.mart_daily_revenue, AS_OF), lake.current("predictions", "mart_revenue_forecast"))


@query(
    "seller_on_time",
    f"""
select seller_id, round(1 - avg(late), 6) on_time_rate from {SELLER_CORRECT} t group by 1""",
)
def seller_on_time(m):
    stats = features.seller_lifetime_stats(sold(m))
    return stats.select("seller_id", reports.on_time_rate("delay_rate_raw").alias("on_time_rate"))


@query(
    "customer_scoring_base",
    f"""
select c.customer_unique_id, c.customer_state, date_diff('day', max(cast(o.order_purchase_timestamp as date)), date '{AS_OF}') recency_days,
  cast(sum(i.price) + sum(i.freight_value) as double) monetary,
  round(ln(1 + greatest(date_diff('day', max(cast(o.order_purchase_timestamp as date)), date '{AS_OF}'), 0)), 6) recency_log,
  round(ln(1 + greatest(cast(sum(i.price) + sum(i.freight_value) as double), 0)), 6) monetary_log
from g_profile c join g_orders o on o.customer_unique_id = c.customer_unique_id and o.is_synthetic join v_items i on i.order_id = o.order_id
group by 1, 2""",
)
def customer_scoring_base(m):
    return features.customer_scoring_base(
        m.fct_orders.where("is_synthetic"), gold.customer_profile(m.silver_customers), m.fct_items, AS_OF
    )


@query(
    "share_of_max",
    f"select category, revenue, orders, round(revenue / max(revenue) over (), 6) share_of_max from ({CATEGORY_SQL}) t",
)
def share_of_max(m):
    table = reports.revenue_by_category(m.order_facts, m.fct_items, m.dim_products, limit=None)
    return reports.share_of_max(table, "revenue")


CLUSTERS_SQL = """(select *, case segment_label when 'active' then 0 when 'at_risk' then 1 else 2 end "cluster" from g_dim_customers)"""


@query(
    "cluster_labels",
    f"""
with c as (select "cluster", avg(cast(recency_days as double)) r, avg(cast(monetary as double)) v from {CLUSTERS_SQL} t group by 1),
mid as (select median(r) mr, median(v) mv from c)
select "cluster", round(r, 6) avg_recency, round(v, 6) avg_monetary,
  case when r <= mr and v >= mv then 'Recent & High-Value' when r <= mr then 'Recent & Modest-Spend'
       when v >= mv then 'Lapsed & High-Value' else 'Lapsed & Low-Value' end segment
from c cross join mid""",
)
def cluster_labels(m):
    """Recency labels as clusters."""
    code = F.when(F.col("segment_label") == "active", 0).when(F.col("segment_label") == "at_risk", 1).otherwise(2)
    clustered = m.dim_customers.select(code.alias("cluster"), F.col("recency_days").alias("recency"), "monetary")
    return scoring.customer_cluster_labels(clustered)


@query(
    "seller_cluster_labels",
    f"""
with t as ({_stats("select seller_id, count(*) n_orders, sum(price) revenue, avg(late) delay_rate_raw, sum(score_sum) / cast(sum(score_n) as double) review_raw from " + SELLER_CORRECT + " t group by 1").strip()}),
c as (select n_orders % 3 "cluster", avg(n_orders) n_orders, avg(revenue) revenue, avg(delay_rate) delay_rate, avg(review_score) review_score from t group by 1),
mid as (select median(revenue) mr from c)
select "cluster", round(n_orders, 4) n_orders, round(revenue, 2) revenue, round(delay_rate, 4) delay_rate, round(review_score, 4) review_score,
  case when review_score < 3.9 or delay_rate > 0.12 then 'At-Risk Seller' when revenue >= mr then 'Top Seller' else 'Small/Low-Volume Seller' end segment
from c cross join mid""",
)
def seller_cluster_labels(m):
    """Clusters stood in for by the remainder of the order count."""
    clustered = features.seller_lifetime_stats(sold(m)).withColumn("cluster", F.col("n_orders") % 3)
    labels = scoring.seller_cluster_labels(clustered)
    return labels.withColumns(
        {
            "n_orders": F.round("n_orders", 4),
            "revenue": F.round("revenue", 2),
            "delay_rate": F.round("delay_rate", 4),
            "review_score": F.round("review_score", 4),
        }
    )
