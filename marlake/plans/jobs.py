"""The jobs of the platform: load, backfill, live ingest, rebuild, checks, scoring."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.operators import quality
from marlake.plans import features, gold, marts, ml, replay, scoring, series, silver
from marlake.session import stage
from marlake.sources import files
from marlake.sources.lake import BATCH, Lake
from marlake.sources.schemas import ORDER_STATUSES, RAW_SCHEMAS, REVIEW_SCORES, TABLE_KEYS
from marlake.streaming import revenue
from marlake.streaming.incremental import FACT_KEYS, INGEST
from marlake.streaming.windows import windows_between, with_batch_window

TS = "order_purchase_timestamp"
BATCH_TABLES = ["customers", "orders", "order_items", "order_payments", "order_reviews"]
STATIC_TABLES = ["products", "sellers", "geolocation", "category_translation"]


# --- loads ----------------------------------------------------------------------------------
def load_raw(lake: Lake, paths: dict[str, str], force: bool = False) -> DataFrame:
    """Nine CSV inputs to raw tables, each once; returns source rows against loaded rows."""
    sources = {name: files.read_raw(lake.spark, name, paths[name]) for name in RAW_SCHEMAS}
    for name, df in sources.items():
        lake.load_once("raw", name, df, force)
    return files.reconcile(sources, {name: lake.read("raw", name) for name in sources})


def load_historical(lake: Lake) -> None:
    """Raw tables to bronze, one historical batch per table."""
    for name in RAW_SCHEMAS:
        df = lake.read("raw", name)
        if name == "geolocation":
            df = files.keep_first_zip(df)
        tagged = files.tag(df, f"historical_{name}", False)
        if name != "orders":
            tagged = tagged.drop("source_template_date")
        lake.append_new_batch("bronze", f"bronze_{name}", tagged.drop(BATCH), f"historical_{name}")


# --- arriving rows --------------------------------------------------------------------------
def landed(lake: Lake, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The CSV files of a landing folder, one path per batch table."""
    return {name: files.read_raw(lake.spark, name, paths[name]) for name in BATCH_TABLES}


def write_arrivals(lake: Lake, arrivals: dict[str, DataFrame], orders: DataFrame) -> None:
    """Write orders that carry a batch id, and the customers and children that arrived with them, to bronze.

    A child goes into the batch of its order, a customer into the first batch that names them.
    Batches that are written again replace their partitions.
    """
    orders = stage(orders, "arrivals")
    of_order = orders.select("order_id", BATCH)
    of_customer = orders.groupBy("customer_id").agg(F.min(BATCH).alias(BATCH))

    def write(table: str, rows: DataFrame) -> None:
        tagged = files.tag(rows, F.col(BATCH), True)
        lake.write_batches("bronze", f"bronze_{table}", tagged if table == "orders" else tagged.drop("source_template_date"))

    write("customers", arrivals["customers"].join(of_customer, "customer_id"))
    for table in ("order_items", "order_payments", "order_reviews"):
        write(table, arrivals[table].join(of_order, "order_id"))
    # Orders last: a day counts as loaded once its orders are there.
    write("orders", orders)


def backfill(lake: Lake, arrivals: dict[str, DataFrame], start: date, end: date) -> list[date]:
    """Load the arrived rows of every day from the cursor (or ``start``) to ``end``, one batch per day, in one job."""
    cursor = lake.get_state(INGEST)
    first = start if cursor is None else cursor.date() + timedelta(days=1)
    days = [first + timedelta(days=i) for i in range((end - first).days + 1)]
    if not days:
        return []
    day = F.to_date(TS)
    due = arrivals["orders"].where(day.between(F.lit(first), F.lit(end)))
    write_arrivals(lake, arrivals, due.withColumn(BATCH, F.concat(F.lit("backfill-"), day.cast("string"))))
    lake.set_state(INGEST, datetime.combine(end, time.max, tzinfo=timezone.utc))
    return days


def live_ingest(lake: Lake, arrivals: dict[str, DataFrame], now: datetime, hours: int = 6) -> list[str]:
    """Load the arrived rows of every complete window between the cursor and ``now``, and move the cursor."""
    cursor = lake.get_state(INGEST)
    if cursor is None:
        raise RuntimeError("run the backfill first")
    due = windows_between(cursor.replace(tzinfo=None), now.replace(tzinfo=None), hours)
    if not due:
        return []
    rows = arrivals["orders"].where((F.col(TS) >= F.lit(due[0][0])) & (F.col(TS) < F.lit(due[-1][1])))
    cut = with_batch_window(rows, TS, hours).drop("window_start", "window_end")
    write_arrivals(lake, arrivals, cut)
    lake.set_state(INGEST, due[-1][1].replace(tzinfo=timezone.utc))
    return [batch for _, _, batch in due]


# --- full rebuild ---------------------------------------------------------------------------
def replace_batches(lake: Lake, layer: str, table: str, df: DataFrame, keys: list[str]) -> None:
    """Write all batches of a keyed table and drop the partitions that no longer have rows."""
    lake.write_batches(layer, table, stage(df, table), keys, replace=lake.parts(layer, table))


def rebuild(lake: Lake) -> None:
    """Silver, facts, dimensions and marts from all of bronze."""
    def bronze(name):
        return lake.read("bronze", f"bronze_{name}")

    rules = {
        "customers": silver.customers,
        "orders": silver.orders,
        "order_items": silver.order_items,
        "order_payments": silver.payments,
        "order_reviews": silver.reviews,
    }
    for table, rule in rules.items():
        replace_batches(lake, "silver", f"silver_{table}", rule(bronze(table)), TABLE_KEYS[table])
    lake.publish("silver", "silver_products", silver.products(bronze("products"), bronze("category_translation").select("product_category_name", "product_category_name_english")))
    lake.publish("silver", "silver_sellers", silver.sellers(bronze("sellers")))
    lake.publish("silver", "silver_geolocation", silver.geolocation(bronze("geolocation")))

    def clean(name):
        return lake.read("silver", f"silver_{name}")

    facts = {
        "fct_orders": gold.fct_orders(clean("orders"), clean("customers")),
        "fct_order_items": gold.fct_order_items(clean("order_items")),
        "fct_payments": gold.fct_payments(clean("order_payments")),
        "fct_reviews": gold.fct_reviews(clean("order_reviews")),
    }
    for table, df in facts.items():
        replace_batches(lake, "gold", table, df, FACT_KEYS[table])
    lake.publish("gold", "dim_products", gold.dim_products(lake.current("silver", "silver_products")))
    lake.publish("gold", "dim_sellers", gold.dim_sellers(lake.current("silver", "silver_sellers")))
    lake.publish("gold", "dim_geolocation", gold.dim_geolocation(lake.current("silver", "silver_geolocation")))
    lake.publish("gold", "dim_date", gold.dim_date(gold.date_spine(lake.spark)))
    revenue.restart(lake)
    refresh_aggregates(lake)


def refresh_aggregates(lake: Lake) -> None:
    """The daily part: tables that depend on all orders at once."""
    def clean(name):
        return lake.read("silver", f"silver_{name}")

    lake.publish("gold", "dim_customers", gold.dim_customers(clean("customers"), clean("orders"), clean("order_payments")))
    lake.publish("gold", "mart_customer_rfm", marts.customer_rfm(lake.current("gold", "dim_customers")))
    # Incremental runs keep this one up to date; it is not computed from the orders again.
    revenue.compact(lake)
    lake.publish("gold", "mart_daily_revenue", revenue.current(lake))


def gold_frames(lake: Lake) -> dict[str, DataFrame]:
    """The frames the feature functions take."""
    return {
        "orders": lake.read("gold", "fct_orders"),
        "profiles": lake.current("gold", "dim_customers"),
        "items": lake.read("gold", "fct_order_items"),
        "products": lake.current("gold", "dim_products"),
        "sellers": lake.current("gold", "dim_sellers"),
        "payments": lake.read("gold", "fct_payments"),
        "geolocation": lake.current("gold", "dim_geolocation"),
        "reviews": lake.read("gold", "fct_reviews"),
    }


def checks(lake: Lake) -> DataFrame:
    """All declared data checks over silver and gold."""
    g = gold_frames(lake)
    q = quality
    customers, orders = lake.read("silver", "silver_customers"), lake.read("silver", "silver_orders")
    reviews = lake.read("silver", "silver_order_reviews")
    return q.report(
        [
            q.not_null(customers, "silver_customers", ["customer_id", "customer_unique_id"]),
            q.unique(customers, "silver_customers", "customer_id"),
            q.not_null(orders, "silver_orders", ["order_id"]),
            q.unique(orders, "silver_orders", "order_id"),
            q.accepted_values(orders, "silver_orders", "order_status", ORDER_STATUSES),
            q.not_null(g["items"], "fct_order_items", ["order_id"]),
            q.not_null(g["payments"], "fct_payments", ["order_id"]),
            q.not_null(reviews, "silver_order_reviews", ["review_id"]),
            q.unique(reviews, "silver_order_reviews", "review_id"),
            q.accepted_values(reviews, "silver_order_reviews", "review_score", REVIEW_SCORES),
            q.not_null(g["products"], "dim_products", ["product_id"]),
            q.unique(g["products"], "dim_products", "product_id"),
            q.not_null(g["sellers"], "dim_sellers", ["seller_id"]),
            q.unique(g["sellers"], "dim_sellers", "seller_id"),
            q.not_null(g["geolocation"], "dim_geolocation", ["geolocation_zip_code_prefix"]),
            q.unique(g["geolocation"], "dim_geolocation", "geolocation_zip_code_prefix"),
            q.not_null(lake.current("gold", "dim_date"), "dim_date", ["date_day"]),
            q.unique(lake.current("gold", "dim_date"), "dim_date", "date_day"),
            q.not_null(g["profiles"], "dim_customers", ["customer_unique_id"]),
            q.unique(g["profiles"], "dim_customers", "customer_unique_id"),
            q.not_null(g["orders"], "fct_orders", ["order_id"]),
            q.unique(g["orders"], "fct_orders", "order_id"),
            q.not_null(g["reviews"], "fct_reviews", ["review_id"]),
            q.unique(g["reviews"], "fct_reviews", "review_id"),
            q.all_relationships(
                {"fct_orders": g["orders"], "fct_order_items": g["items"], "fct_payments": g["payments"], "fct_reviews": g["reviews"], "dim_customers": g["profiles"], "dim_products": g["products"]},
                [
                    ("fct_orders", "customer_unique_id", "dim_customers", "customer_unique_id"),
                    ("fct_order_items", "order_id", "fct_orders", "order_id"),
                    ("fct_order_items", "product_id", "dim_products", "product_id"),
                    ("fct_payments", "order_id", "fct_orders", "order_id"),
                    ("fct_reviews", "order_id", "fct_orders", "order_id"),
                ],
            ),
            q.not_null(lake.current("gold", "mart_daily_revenue"), "mart_daily_revenue", ["date_day"]),
            q.not_null(lake.current("gold", "mart_customer_rfm"), "mart_customer_rfm", ["customer_unique_id"]),
            q.unique(lake.current("gold", "mart_customer_rfm"), "mart_customer_rfm", "customer_unique_id"),
        ]
    )


# --- training -------------------------------------------------------------------------------
def train_delivery_risk(lake: Lake, **trees) -> None:
    train = stage(features.delivery_features(gold_frames(lake), training=True), "train")
    numeric, categorical = features.DELIVERY_NUMERIC, features.DELIVERY_CATEGORICAL
    lake.save_model("delivery_risk", ml.fit_classifier(train, "is_delayed_num", numeric, categorical, **(trees or ml.DELIVERY_TREES)))


def train_review_risk(lake: Lake, **trees) -> None:
    train = stage(features.review_features(gold_frames(lake), training=True), "train")
    numeric, categorical = features.REVIEW_NUMERIC, features.REVIEW_CATEGORICAL
    lake.save_model("review_risk", ml.fit_classifier(train, "negative_review", numeric, categorical, **(trees or ml.REVIEW_TREES)))


def train_customers(lake: Lake, **trees) -> None:
    """Value model and clusters of the historical customers, with the names of the clusters."""
    g = gold_frames(lake)
    past = g["orders"].where(~F.col("is_synthetic"))
    train = stage(features.incremental_value(past, g["profiles"], g["items"], g["products"], g["payments"]), "train")
    train = features.impute(train, "first_order_weight")
    numeric, categorical = features.VALUE_NUMERIC, features.VALUE_CATEGORICAL
    lake.save_model("customer_value", ml.fit_value_model(train, "log_incremental_clv", numeric, categorical, **(trees or ml.VALUE_TREES)))
    rfm = lake.current("gold", "mart_customer_rfm").where(~F.col("is_synthetic"))
    clusters = ml.fit_clusters(rfm, ["recency_log", "monetary_log"])
    lake.save_model("customer_clusters", clusters)
    lake.publish("models", "customer_cluster_names", scoring.customer_cluster_labels(ml.assign_clusters(clusters, rfm)))


def train_sellers(lake: Lake) -> None:
    train = seller_stats(lake, ~F.col("is_synthetic"))
    clusters = ml.fit_clusters(train, features.SELLER_CLUSTERS)
    lake.save_model("seller_clusters", clusters)
    lake.publish("models", "seller_cluster_names", scoring.seller_cluster_labels(ml.assign_clusters(clusters, train)))


def seller_stats(lake: Lake, cohort) -> DataFrame:
    g = gold_frames(lake)
    sold = features.seller_orders(g["orders"].where(cohort), g["items"], g["reviews"])
    return stage(features.seller_lifetime_stats(sold), "sellers")


# --- scoring with the stored models ---------------------------------------------------------
def score_delivery_risk(lake: Lake) -> bool:
    numeric, categorical = features.DELIVERY_NUMERIC, features.DELIVERY_CATEGORICAL
    waiting = features.delivery_features(gold_frames(lake), training=False)
    scored = ml.score(lake.load_model("delivery_risk"), waiting, numeric, categorical, "risk_score")
    columns = ["order_id", "seller_id", "customer_state", "main_category", "risk_score", "promised_delivery_days"]
    return lake.publish_scores(
        "predictions_delivery_risk", scoring.risk_tiers(stage(scored.select(*columns), "scored"), "risk_score", "order_id")
    )


def score_review_risk(lake: Lake) -> bool:
    numeric, categorical = features.REVIEW_NUMERIC, features.REVIEW_CATEGORICAL
    pending = features.review_features(gold_frames(lake), training=False)
    scored = ml.score(lake.load_model("review_risk"), pending, numeric, categorical, "risk_score")
    chosen = scored.select("order_id", "seller_id", "main_category", "risk_score", F.col("is_delayed").alias("was_delayed"))
    return lake.publish_scores(
        "predictions_negative_review_risk", scoring.risk_tiers(stage(chosen, "scored"), "risk_score", "order_id")
    )


def score_customers(lake: Lake, as_of: str) -> bool:
    """Segments and predicted value of the synthetic customers, and what to do about them."""
    g = gold_frames(lake)
    live = g["orders"].where("is_synthetic")
    base = features.customer_scoring_base(live, g["profiles"], g["items"], as_of)
    first = features.first_order_features(live, g["items"], g["products"], g["payments"])
    customers = stage(base.join(first, "customer_unique_id", "left"), "customers")
    filled = features.impute(features.impute(customers, "first_order_weight"), "payment_installments", fill=1)
    value = lake.load_model("customer_value")
    valued = ml.predict_value(value, filled, features.VALUE_NUMERIC, features.VALUE_CATEGORICAL, "predicted_incremental_value")
    names = lake.current("models", "customer_cluster_names")
    named = scoring.name_clusters(ml.assign_clusters(lake.load_model("customer_clusters"), valued), names)
    columns = ["customer_unique_id", "customer_state", "segment", "predicted_incremental_value"]
    return lake.publish_scores(
        "predictions_customer_actions", scoring.suggested_action(stage(named.select(*columns), "valued"))
    )


def score_sellers(lake: Lake, as_of: str) -> bool:
    g = gold_frames(lake)
    clusters, names = lake.load_model("seller_clusters"), lake.current("models", "seller_cluster_names")
    named = scoring.name_clusters(ml.assign_clusters(clusters, seller_stats(lake, F.col("is_synthetic"))), names).select(
        "seller_id",
        "segment",
        F.col("n_orders").alias("lifetime_orders"),
        F.col("revenue").alias("lifetime_revenue"),
        F.col("delay_rate").alias("lifetime_delay_rate"),
        F.col("review_score").alias("lifetime_review_score"),
    )
    live = g["orders"].where("is_synthetic")
    recent = features.seller_window_metrics(features.seller_orders(live, g["items"], g["reviews"]), as_of)
    return lake.publish_scores("predictions_seller_segments", named.join(recent, "seller_id", "left"))


def refresh_forecast(lake: Lake, historical_end: str = replay.STABLE_END) -> bool:
    g = gold_frames(lake)
    daily = stage(ml.forecast_input(g["orders"], g["items"], historical_end), "daily")
    years = ml.years_of(daily)
    if not years:
        return False
    holidays = ml.holiday_days(ml.holiday_calendar(lake.spark, years))
    return lake.publish_scores("mart_revenue_forecast", ml.forecast(daily, holidays))


def refresh_category_forecasts(lake: Lake, historical_end: str = replay.STABLE_END) -> bool:
    """Forecast of every category, all in one job."""
    g = gold_frames(lake)
    daily = stage(series.daily_by_category(g["orders"], g["items"], g["products"], historical_end), "daily")
    years = ml.years_of(daily)
    if not years:
        return False
    holidays = ml.holiday_days(ml.holiday_calendar(lake.spark, years))
    ahead = series.forecast_many(daily, holidays).withColumnRenamed("key", "category")
    return lake.publish_scores("mart_category_forecast", ahead)
