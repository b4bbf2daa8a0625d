"""The whole path from CSV files to scoring tables, on a small market."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlake.operators.dedup import differences
from marlake.plans import gold, jobs, silver
from marlake.sources.lake import Lake
from marlake.sources.schemas import RAW_SCHEMAS
from marlake.streaming import incremental

UTC = dt.timezone.utc
DAYS = 28


LANDED = {}


def landing(frames):
    """New orders of March 2024 as they land: 20 a day, with ids of their own."""
    order = F.concat(F.lit("n"), "order_id")
    orders = frames["orders"].where("day(order_purchase_timestamp) <= 8")
    stamps = [c for c, kind in orders.dtypes if kind == "timestamp"]
    new = {"orders": orders.withColumns({c: F.col(c) + F.expr("make_interval(7)") for c in stamps}), "customers": frames["customers"]}
    new |= {t: frames[t] for t in ("order_items", "order_payments", "order_reviews")}
    ids = {"order_id": order, "customer_id": F.concat(F.lit("n"), "customer_id"), "review_id": F.concat(F.lit("n"), "review_id")}
    return {t: df.withColumns({c: v for c, v in ids.items() if c in df.columns}) for t, df in new.items()}


def write_csv(df, path):
    df.coalesce(1).write.option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("market")
    o = spark.range(DAYS * 20).selectExpr(
        "concat('o', id) order_id", "concat('c', id) customer_id",
        "case when id % 10 = 9 then 'shipped' else 'delivered' end order_status",
        f"timestamp'2017-03-01 00:00:00' + (id % {DAYS}) * interval '1' day + (id % 24) * interval '1' hour order_purchase_timestamp",
        "id",
    )
    p = "order_purchase_timestamp"
    frames = {
        "orders": o.selectExpr(
            "order_id", "customer_id", "order_status", p, f"{p} + interval '1' hour order_approved_at", f"{p} + interval '20' hour order_delivered_carrier_date",
            f"case when order_status = 'delivered' then {p} + (id % 9) * interval '1' day end order_delivered_customer_date",
            f"{p} + interval '6' day order_estimated_delivery_date",
        ),
        "customers": o.selectExpr("customer_id", "concat('p', id % 300) customer_unique_id", "lpad(cast(id % 5 as string), 5, '0') customer_zip_code_prefix", "' Rio ' customer_city", "concat('s', id % 3) customer_state"),
        "order_items": o.selectExpr("order_id", "1 order_item_id", "concat('x', id % 7) product_id", "concat('s', id % 6) seller_id", f"{p} shipping_limit_date", "10 + id % 50 price", "5 + id % 3 freight_value"),
        "order_payments": o.selectExpr("order_id", "1 payment_sequential", "case when id % 3 = 0 then 'boleto' else 'credit_card' end payment_type", "1 + id % 4 payment_installments", "15 + id % 50 payment_value"),
        "order_reviews": o.where("id % 10 < 7").selectExpr("concat('r', id) review_id", "order_id", "1 + id % 5 review_score", "'a, b' review_comment_title", "'line\n\"two\"' review_comment_message", f"{p} review_creation_date", f"{p} + interval '30' hour review_answer_timestamp"),
        "products": spark.range(7).selectExpr("concat('x', id) product_id", "concat('cat', id % 3) product_category_name", "id * 100 product_weight_g", "10 product_length_cm", "5 product_height_cm", "4 product_width_cm", "2 product_photos_qty"),
        "sellers": spark.range(6).selectExpr("concat('s', id) seller_id", "lpad(cast(id % 5 as string), 5, '0') seller_zip_code_prefix", "'poa' seller_city", "concat('S', id % 2) seller_state"),
        "geolocation": spark.range(10).selectExpr("lpad(cast(id % 5 as string), 5, '0') geolocation_zip_code_prefix", "-20.0 - id geolocation_lat", "-40.0 - id geolocation_lng", "'rio' geolocation_city", "'RJ' geolocation_state"),
        "category_translation": spark.createDataFrame([("cat0", "zero")], "product_category_name string, product_category_name_english string"),
    }
    for name, df in frames.items():
        write_csv(df, f"{root}/csv/{name}")
    for name, df in landing(frames).items():
        write_csv(df, f"{root}/landing/{name}")
    lake = Lake(spark, f"{root}/lake")
    report = jobs.load_raw(lake, {name: f"{root}/csv/{name}" for name in RAW_SCHEMAS})
    assert report.where("not matches").count() == 0 and report.count() == 9
    jobs.load_historical(lake)
    LANDED.update(jobs.landed(lake, {name: f"{root}/landing/{name}" for name in jobs.BATCH_TABLES}))
    assert jobs.backfill(lake, LANDED, dt.date(2024, 3, 1), dt.date(2024, 3, 6)) == [dt.date(2024, 3, d) for d in range(1, 7)]
    jobs.rebuild(lake)
    return lake


def test_layers_are_built_and_clean(lake):
    failed = [r for r in jobs.checks(lake).collect() if r.failures]
    assert not failed, failed
    orders = lake.read("gold", "fct_orders")
    assert orders.where("not is_synthetic").count() == DAYS * 20
    by_day = {r[0]: r[1] for r in orders.where("is_synthetic").groupBy("batch_id").count().collect()}
    assert len(by_day) == 6 and set(by_day.values()) == {20}
    review = lake.read("silver", "silver_order_reviews").where("review_id = 'r0'").head()
    assert review.review_comment_message == 'line\n"two"'


def test_live_windows_follow_the_backfill_and_equal_a_rebuild(lake):
    # The cursor lies one microsecond before midnight; no window of the 6th may come again.
    incremental.bootstrap(lake, dt.datetime(2024, 3, 7, tzinfo=UTC))
    now = dt.datetime(2024, 3, 7, 13, tzinfo=UTC)
    batches = jobs.live_ingest(lake, LANDED, now)
    assert batches == ["live-2024-03-07-00-06", "live-2024-03-07-06-12"]
    assert jobs.live_ingest(lake, LANDED, now) == []
    assert incremental.run_pending(lake) == batches
    facts = lake.read("gold", "fct_orders")
    full = gold.fct_orders(
        silver.orders(lake.read("bronze", "bronze_orders")), silver.customers(lake.read("bronze", "bronze_customers"))
    )
    d = differences(full, facts.select(*full.columns)).head()
    assert (d.only_left, d.only_right) == (0, 0)
    assert 0 < facts.where(F.col("batch_id").startswith("live-")).count() < 20
    jobs.refresh_aggregates(lake)
    total = lake.current("gold", "mart_daily_revenue").agg(F.sum("order_count")).head()[0]
    assert total == facts.count()


def test_scoring_tables(lake):
    trees = {"maxIter": 2, "maxDepth": 2}
    with pytest.raises(RuntimeError, match="has not been trained"):
        jobs.score_delivery_risk(lake)
    jobs.train_delivery_risk(lake, **trees)
    jobs.train_review_risk(lake, **trees)
    jobs.train_customers(lake, **trees)
    jobs.train_sellers(lake)
    assert jobs.score_delivery_risk(lake) and jobs.score_review_risk(lake)
    before = lake.current("predictions", "predictions_delivery_risk").drop("scored_at")
    assert jobs.score_delivery_risk(lake)  # a second scoring with the stored model gives the same rows
    d = differences(before, lake.current("predictions", "predictions_delivery_risk").drop("scored_at")).head()
    assert (d.only_left, d.only_right) == (0, 0)
    risk = lake.current("predictions", "predictions_delivery_risk")
    open_orders = lake.read("gold", "fct_orders").where("is_synthetic and order_status = 'shipped'").count()
    assert risk.count() == open_orders > 0 and risk.where("risk_score between 0 and 1 and scored_at is not null").count() == open_orders
    assert jobs.score_customers(lake, "2024-03-10") and jobs.score_sellers(lake, "2024-03-07")
    people = lake.current("predictions", "predictions_customer_actions")
    assert people.where("predicted_incremental_value < 0 or segment is null").count() == 0 and people.count() > 0
    sellers = lake.current("predictions", "predictions_seller_segments")
    assert sellers.count() == 6 and sellers.agg(F.sum("orders_this_week")).head()[0] > 0
    assert jobs.refresh_forecast(lake)
    assert lake.current("predictions", "mart_revenue_forecast").count() == 90
    assert jobs.refresh_category_forecasts(lake)
    ahead = lake.current("predictions", "mart_category_forecast")
    sold = lake.read("gold", "fct_order_items").join(lake.current("gold", "dim_products"), "product_id")
    assert ahead.count() == 90 * ahead.select("category").distinct().count() > 0
    assert ahead.select("category").distinct().count() <= sold.select("product_category_name_english", "product_category_name").distinct().count()
