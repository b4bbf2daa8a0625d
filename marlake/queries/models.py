"""Models, splits, evaluation and forecast."""

from pyspark.sql import functions as F

from marlake.plans import features, ml, scoring
from marlake.queries.features import frames
from marlake.queries.layers import REPEAT_SQL, DELAY_SQL
from marlake.queries.registry import query
from marlake.queries.reports import AS_OF, STATS_SQL, WINDOWS_SQL, sold
from marlake.queries.views import hashed
from marlake.session import stage

HISTORICAL_END = "2000-12-31"


# --- clusters -------------------------------------------------------------------------------
# Scores and clusters depend on the solver; the queries return the rows they are for, the columns that SQL can
# state, and whether the model's own columns are what they must be. The jobs store the scores themselves.
SELLER_SEGMENTS = ["At-Risk Seller", "Top Seller", "Small/Low-Volume Seller"]


def known(column, names):
    return F.col(column).isin(list(names))


@query("ml_customer_segments", "select customer_unique_id, recency, cast(monetary as double) monetary, true segment_known from g_rfm where is_synthetic")
def ml_customer_segments(m):
    """Clusters trained on the historical cohort name the customers of the synthetic one."""
    rfm = stage(m.mart_customer_rfm, "rfm")
    train = rfm.where(~F.col("is_synthetic"))
    model = ml.fit_clusters(train, ["recency_log", "monetary_log"])
    labels = scoring.customer_cluster_labels(ml.assign_clusters(model, train))
    live = ml.assign_clusters(model, rfm.where("is_synthetic"))
    named = scoring.name_clusters(live, labels)
    return named.select("customer_unique_id", "recency", "monetary", known("segment", scoring.CUSTOMER_SEGMENTS).alias("segment_known"))


@query(
    "ml_seller_segments",
    f"""
select s.seller_id, s.n_orders lifetime_orders, s.revenue lifetime_revenue, s.delay_rate lifetime_delay_rate, s.review_score lifetime_review_score,
  true nearest, true segment_known, w.* exclude (seller_id)
from ({STATS_SQL}) s left join ({WINDOWS_SQL}) w on w.seller_id = s.seller_id""",
)
def ml_seller_segments(m):
    m = m.written()

    def stats(cohort):
        per_order = features.seller_orders(m.order_facts.where(cohort), m.fct_items, m.fct_reviews)
        return stage(features.seller_lifetime_stats(per_order), "sellers")

    train = stats(~F.col("is_synthetic"))
    model = ml.fit_clusters(train, features.SELLER_CLUSTERS)
    labels = scoring.seller_cluster_labels(ml.assign_clusters(model, train))
    learned = ml.parameter_rows(model, features.SELLER_CLUSTERS, [])
    live = ml.assign_clusters(model, stats(F.col("is_synthetic")))
    live = live.withColumn("nearest", ml.is_nearest(learned, features.SELLER_CLUSTERS))
    windows = features.seller_window_metrics(sold(m), AS_OF)
    return (
        scoring.name_clusters(live, labels)
        .select(
            "seller_id",
            "nearest",
            known("segment", SELLER_SEGMENTS).alias("segment_known"),
            F.col("n_orders").alias("lifetime_orders"),
            F.col("revenue").alias("lifetime_revenue"),
            F.col("delay_rate").alias("lifetime_delay_rate"),
            F.col("review_score").alias("lifetime_review_score"),
        )
        .join(windows, "seller_id", "left")
    )


@query("ml_elbow", "select cast(k as integer) k, true cost_known, true cost_falls from (select unnest(generate_series(2, 8)) k) t")
def ml_elbow(m):
    rfm = stage(m.mart_customer_rfm.where(~F.col("is_synthetic")), "rfm")
    costs = ml.elbow(rfm, ["recency_log", "monetary_log"])
    two = costs.where("k = 2").select("training_cost").scalar()
    return costs.select("k", (F.col("training_cost") >= 0).alias("cost_known"), (F.col("training_cost") <= two).alias("cost_falls"))


# --- classifiers ----------------------------------------------------------------------------
@query(
    "ml_delivery_risk",
    """
select order_id, seller_id, customer_state, coalesce(main_category, 'missing') main_category, round(promised_delivery_days, 6) promised_delivery_days, true scored, true tier_known
from g_delivery where is_synthetic and order_status not in ('delivered', 'canceled')""",
)
def ml_delivery_risk(m):
    """Open orders with the probability of a delay and its tier."""
    f = frames(m)
    train = stage(features.delivery_features(f, training=True), "train")
    numeric, categorical = features.DELIVERY_NUMERIC, features.DELIVERY_CATEGORICAL
    model = ml.fit_classifier(train, "is_delayed_num", numeric, categorical, **ml.DELIVERY_TREES)
    waiting = features.delivery_features(f, training=False)
    scored = ml.score(model, waiting, numeric, categorical, "risk_score")
    columns = ["order_id", "seller_id", "customer_state", "main_category", "promised_delivery_days"]
    tiers = scoring.risk_tiers(stage(scored.select(*columns, "risk_score"), "scored"), "risk_score", "order_id")
    return tiers.select(*columns, F.col("risk_score").between(0, 1).alias("scored"), known("risk_tier", scoring.TIER_ORDER).alias("tier_known"))


@query(
    "ml_review_risk",
    """
select o.order_id, i.seller_id, coalesce(i.main_category, 'missing') main_category, o.is_delayed was_delayed, true scored, true tier_known
from g_orders o join g_best i on i.order_id = o.order_id join g_paid p on p.order_id = o.order_id
where o.is_synthetic and o.order_status = 'delivered' and o.order_id not in (select order_id from v_reviews)""",
)
def ml_review_risk(m):
    """Delivered orders without review, with the probability of a negative one and its tier."""
    f = frames(m)
    train = stage(features.review_features(f, training=True), "train")
    numeric, categorical = features.REVIEW_NUMERIC, features.REVIEW_CATEGORICAL
    model = ml.fit_classifier(train, "negative_review", numeric, categorical, **ml.REVIEW_TREES)
    pending = features.review_features(f, training=False)
    scored = ml.score(model, pending, numeric, categorical, "risk_score")
    columns = ["order_id", "seller_id", "main_category", "was_delayed"]
    scored = stage(scored.withColumn("was_delayed", F.col("is_delayed")).select(*columns, "risk_score"), "scored")
    tiers = scoring.risk_tiers(scored, "risk_score", "order_id")
    return tiers.select(*columns, F.col("risk_score").between(0, 1).alias("scored"), known("risk_tier", scoring.TIER_ORDER).alias("tier_known"))


@query(
    "ml_incremental_value",
    """
select customer_unique_id, customer_state, true segment_known, true value_known, true action_known from g_profile
where customer_unique_id in (select o.customer_unique_id from g_orders o join v_items i on i.order_id = o.order_id where o.is_synthetic)""",
)
def ml_incremental_value(m):
    """Synthetic customers with predicted value, segment and suggested action."""
    f = frames(m)
    numeric, categorical = features.VALUE_NUMERIC, features.VALUE_CATEGORICAL
    past, live = m.fct_orders.where(~F.col("is_synthetic")), m.fct_orders.where("is_synthetic")
    train = stage(
        features.incremental_value(past, f["profiles"], f["items"], f["products"], f["payments"]), "train"
    )
    model = ml.fit_value_model(train, "log_incremental_clv", numeric, categorical, **ml.VALUE_TREES)
    rfm = stage(m.mart_customer_rfm.where(~F.col("is_synthetic")), "rfm")
    clusters = ml.fit_clusters(rfm, ["recency_log", "monetary_log"])
    labels = scoring.customer_cluster_labels(ml.assign_clusters(clusters, rfm))

    base = features.customer_scoring_base(live, f["profiles"], f["items"], AS_OF)
    first = features.first_order_features(live, f["items"], f["products"], f["payments"])
    customers = stage(base.join(first, "customer_unique_id", "left"), "customers")
    filled = features.impute(features.impute(customers, "first_order_weight"), "payment_installments", fill=1)
    valued = ml.predict_value(model, filled, numeric, categorical, "predicted_incremental_value")
    named = scoring.name_clusters(ml.assign_clusters(clusters, valued), labels)
    actions = scoring.suggested_action(
        stage(named.select("customer_unique_id", "customer_state", "segment", "predicted_incremental_value"), "scored")
    )
    return actions.select(
        "customer_unique_id",
        "customer_state",
        known("segment", scoring.CUSTOMER_SEGMENTS).alias("segment_known"),
        (F.col("predicted_incremental_value") >= 0).alias("value_known"),
        known("suggested_action", scoring.ACTIONS).alias("action_known"),
    )


def held_out(rows, label, key, columns):
    """SQL: test rows of the stratified split with the weight that their class has in training, and how the score must be."""
    return f"""
with r as (select *, row_number() over (partition by {label} order by {hashed("'split'", key)}, {key}) - 1 k, count(*) over (partition by {label}) n from ({rows}) z),
s as (select *, k < round(n * 0.2e0) is_test from r),
c as (select {label}, (select count(*) from s where not is_test) / (2e0 * count(*)) class_weight from s where not is_test group by 1)
select {columns}, {label}, round(class_weight, 6) class_weight, true probability_holds from s left join c using ({label}) where is_test"""


def scored_by_table(split, label, numeric, categorical, columns):
    """Test rows with their class weight, and whether the model's probability is that of its stored parameters."""
    train = stage(split.where(~F.col("is_test")), "train")
    model = ml.fit_logistic(train, label, numeric, categorical)
    learned = ml.parameter_rows(model, numeric, categorical)
    scored = ml.score(model, split.where("is_test"), numeric, categorical, "probability")
    weights = ml.balanced_weight(train, label, False).groupBy(F.col(label).alias("_label")).agg(F.max("weight").alias("class_weight"))
    same = F.abs(F.col("probability") - ml.probability_from(learned, numeric, categorical)) < 1e-9
    joined = scored.withColumn("probability_holds", same).join(F.broadcast(weights), F.col(label) == F.col("_label"), "left")
    return joined.select(*columns, label, "class_weight", "probability_holds")


REPEAT_NUMERIC = [
    "first_order_price", "first_order_freight", "first_order_n_items", "payment_installments",
    "purchase_day_of_week", "purchase_month",
]
REPEAT_CATEGORICAL = ["first_order_main_category", "payment_type"]


@query("ml_repeat_purchase", held_out(f"select * from ({REPEAT_SQL}) t where not is_synthetic", "repeat_purchase", "customer_unique_id", "customer_unique_id"))
def ml_repeat_purchase(m):
    """Balanced logistic regression on the first order, scored on the held-out fifth."""
    from marlake.plans.marts import repeat_purchase

    m = m.written()
    mart = repeat_purchase(m.fct_orders, m.fct_items, m.dim_products, m.fct_payments)
    split = stage(
        ml.stratified_split(mart.where(~F.col("is_synthetic")), "repeat_purchase", "customer_unique_id"), "split"
    )
    return scored_by_table(split, "repeat_purchase", REPEAT_NUMERIC, REPEAT_CATEGORICAL, ["customer_unique_id"])


@query(
    "ml_delivery_delay",
    held_out(
        f"select order_id, seller_id, cast(is_delayed as int) label_delayed, concat_ws('|', order_id, seller_id) row_key from ({DELAY_SQL}) t where not is_synthetic and is_delayed is not null",
        "label_delayed", "row_key", "order_id, seller_id",
    ),
)
def ml_delivery_delay(m):
    """Balanced logistic regression on the delay mart, scored on the held-out fifth."""
    from marlake.plans.marts import delivery_delay

    numeric = [
        "price", "freight_value", "n_items", "payment_installments", "purchase_day_of_week", "purchase_month",
        "promised_delivery_days",
    ]
    categorical = ["main_category", "payment_type", "seller_state"]
    m = m.written()
    mart = delivery_delay(m.order_facts, m.fct_items, m.dim_products, m.fct_payments, m.dim_sellers)
    rows = mart.where(~F.col("is_synthetic") & F.col("is_delayed").isNotNull()).withColumns(
        {"label_delayed": F.col("is_delayed").cast("int"), "row_key": F.concat_ws("|", "order_id", "seller_id")}
    )
    split = stage(ml.stratified_split(rows, "label_delayed", "row_key"), "split")
    return scored_by_table(split, "label_delayed", numeric, categorical, ["order_id", "seller_id"])


def _spread(column):
    x = f"cast({column} as double)"
    return (
        f"select 'mean' part, '{column}' input, 0 position, null level, round(avg({x}), 4) v, null::boolean rank_holds from t\n"
        f"union all select 'deviation', '{column}', 0, null, round(stddev_samp({x}), 4), null from t\n"
        f"union all select 'median', '{column}', 0, null, null, true"
    )


def _levels(column):
    return f"""select 'level' part, '{column}' input, cast(row_number() over (order by count(*) desc, coalesce({column}, 'missing')) - 1 as int) position,
  coalesce({column}, 'missing') level, null::double v, null::boolean rank_holds from t group by coalesce({column}, 'missing')"""


PARAMETER_SQL = "\nunion all ".join([*[_spread(c) for c in REPEAT_NUMERIC], *[f"select * from ({_levels(c)}) x" for c in REPEAT_CATEGORICAL]])


@query("ml_preprocessing_parameters", f"with t as (select * from ({REPEAT_SQL}) z where not is_synthetic)\nselect part, input, position, level, v \"value\", rank_holds from ({PARAMETER_SQL}) p")
def ml_preprocessing_parameters(m):
    """What the preprocessing learns from the first orders: means, deviations, levels by frequency; medians by their rank, which is off by a thousandth at most."""
    from marlake.plans.marts import repeat_purchase

    m = m.written()
    mart = stage(repeat_purchase(m.fct_orders, m.fct_items, m.dim_products, m.fct_payments).where(~F.col("is_synthetic")), "mart")
    frame = ml.prepared(mart, REPEAT_NUMERIC, REPEAT_CATEGORICAL)
    model = ml.Pipeline(stages=ml.preprocessing(REPEAT_NUMERIC, REPEAT_CATEGORICAL)).fit(frame)
    learned = ml.parameter_rows(model, REPEAT_NUMERIC, REPEAT_CATEGORICAL)
    medians = {c: v for part, c, _, _, v in learned if part == "median"}
    around = [(F.avg((F.col(c) < v).cast("int")) <= 0.501) & (F.avg((F.col(c) <= v).cast("int")) >= 0.499) for c, v in medians.items()]
    ranks = frame.agg(F.map_from_arrays(F.array(*[F.lit(c) for c in medians]), F.array(*around)).alias("m")).scalar()
    median = F.col("part") == "median"
    return (
        ml.parameters(m.spark, learned)
        .withColumn("_ranks", ranks)
        .select(
            "part", "input", "position", "level",
            F.when(~median, F.round("value", 4)).alias("value"),
            F.when(median, F.col("_ranks")[F.col("input")]).alias("rank_holds"),
        )
    )


# --- split and evaluation -------------------------------------------------------------------
@query(
    "stratified_split",
    f"""
with r as (select review_id, cast(review_score <= 2 as int) negative_review,
    row_number() over (partition by review_score <= 2 order by {hashed("'split'", 'review_id')}, review_id) - 1 k,
    count(*) over (partition by review_score <= 2) n from v_reviews)
select review_id, negative_review, k < round(n * 0.2e0) is_test from r""",
)
def stratified_split(m):
    rows = m.reviews.select("review_id", features.negative_review().alias("negative_review"))
    return ml.stratified_split(rows, "negative_review", "review_id")


JUDGED = """(select cast(review_score <= 2 as int) negative_review, least(round(review_response_days, 2) / 10e0, 1e0) score from g_reviews)"""


def judged(m):
    """Response time as a stand-in score for a negative review."""
    score = F.least(F.round("review_response_days", 2) / F.lit(10.0), F.lit(1.0))
    return m.fct_reviews.select(features.negative_review().alias("negative_review"), score.alias("score"))


@query(
    "classification_report",
    f"""
with c as (select negative_review y, cast(score >= 0.5 as int) p, count(*) n from {JUDGED} j group by 1, 2),
s as (select k "class", sum(case when y = k and p = k then n else 0 end) hits, sum(case when p = k then n else 0 end) called,
    sum(case when y = k then n else 0 end) support from c cross join (select unnest([0, 1]) k) x group by 1)
select "class", round(hits / nullif(called, 0), 6) "precision", round(hits / nullif(support, 0), 6) recall,
  round(2 * (hits / nullif(called, 0)) * (hits / nullif(support, 0)) / nullif(hits / nullif(called, 0) + hits / nullif(support, 0), 0), 6) f1,
  cast(support as bigint) support
from s""",
)
def classification_report(m):
    return ml.classification_report(judged(m), "negative_review", "score")


PR_SQL = f"""(with d as (select score, count(*) n, sum(negative_review) h from {JUDGED} j group by 1),
  r as (select score, n, h, sum(n) over (order by score desc) nn, sum(h) over (order by score desc) hh, sum(h) over () pos from d)
  select score threshold, hh / nullif(nn, 0) p, hh / nullif(pos, 0) r, h / nullif(pos, 0) dr from r)"""


@query("pr_curve", f"select round(threshold, 6) threshold, round(p, 6) \"precision\", round(r, 6) recall, round(p * dr, 6) area from {PR_SQL} t")
def pr_curve(m):
    return ml.precision_recall_points(judged(m), "negative_review", "score")


@query("average_precision", f"select round(sum(p * dr), 6) average_precision from {PR_SQL} t")
def average_precision(m):
    return ml.average_precision(ml.precision_recall_points(judged(m), "negative_review", "score"))


# --- forecast -------------------------------------------------------------------------------
FORECAST_SQL = f"""(select cast(o.order_purchase_timestamp as date) ds, sum(price) y from v_items i join g_orders o on o.order_id = i.order_id
  where (not o.is_synthetic and cast(o.order_purchase_timestamp as date) <= date '{HISTORICAL_END}') or o.is_synthetic group by 1)"""


@query("forecast_input", f"select cast(ds as varchar) ds, cast(y as double) y from {FORECAST_SQL} t")
def forecast_input(m):
    return ml.forecast_input(m.order_facts, m.fct_items, HISTORICAL_END)


# The statement lists more years than any date column has; the query takes the years from the data.
YEARS = range(1900, 2101)
CALENDAR = ", ".join(
    f"('{name}', date '{rule(y).isoformat()}', {low}, {high})"
    for name, (rule, low, high) in ml.HOLIDAYS.items()
    for y in YEARS
)


@query(
    "holiday_features",
    f"""
with h as (select holiday, ds + cast(o as integer) ds, o "offset" from (select *, unnest(generate_series(lo, hi)) o from (values {CALENDAR}) t(holiday, ds, lo, hi)) x)
select h.holiday, cast(h.ds as varchar) ds, h."offset", n.orders
from h join (select cast(order_purchase_timestamp as date) ds, count(*) orders from v_orders group by 1) n on n.ds = h.ds""",
)
def holiday_features(m):
    """Days of the holiday windows with their order counts."""
    days = m.orders.groupBy(F.to_date("order_purchase_timestamp").alias("ds")).agg(F.count(F.lit(1)).alias("orders"))
    return ml.holiday_days(ml.holiday_calendar(m.spark, ml.years_of(days))).join(days, "ds")


@query(
    "revenue_forecast",
    f"""
select cast(last + cast(k as integer) as varchar) ds, true interval_holds
from (select max(ds) last from {FORECAST_SQL} t) m cross join (select unnest(generate_series(1, 90)) k) g""",
)
def revenue_forecast(m):
    """Next 90 days of revenue with an interval."""
    daily = stage(ml.forecast_input(m.order_facts, m.fct_items, HISTORICAL_END), "daily")
    holidays = ml.holiday_days(ml.holiday_calendar(m.spark, ml.years_of(daily)))
    ahead = ml.forecast(daily, holidays)
    holds = (F.col("yhat_lower") >= 0) & (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return ahead.select("ds", holds.alias("interval_holds"))


