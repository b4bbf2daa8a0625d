import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlake.operators.dedup import differences
from marlake.plans import replay


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def orders(spark):
    rows = []
    for day in range(1, 29):
        for i in range(4):
            p = dt.datetime(2017, 3, day, 1 + 6 * i, 30)
            rows.append((f"o{day:02d}-{i}", f"c{i}", "delivered", p, p + dt.timedelta(minutes=5), None, p + dt.timedelta(days=3), p + dt.timedelta(days=9)))
    return replay.stable_orders(
        spark.createDataFrame(
            rows,
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp,"
            " order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
        )
    )


def targets(spark, *days):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "target_date date")


def test_stable_window_is_inclusive(spark):
    days = ["2016-12-31", "2017-01-01", "2018-08-31", "2018-09-01"]
    df = spark.createDataFrame([(d, ts(d + " 23:00:00")) for d in days], "order_id string, order_purchase_timestamp timestamp")
    assert sorted(r.order_id for r in replay.stable_orders(df).collect()) == days[1:3]


def test_templates_share_month_and_weekday_else_weekday(spark, orders):
    buckets = replay.calendar_buckets(orders)
    got = {r.target_date: r.template_date for r in replay.template_dates(targets(spark, "2024-03-05", "2024-07-06"), buckets).collect()}
    assert all(a.weekday() == b.weekday() for a, b in got.items()) and len(got) == 2
    assert got[dt.date(2024, 3, 5)].month == 3


def test_replay_keeps_deltas_and_is_repeatable(spark, orders):
    templates = replay.template_dates(targets(spark, "2024-03-05", "2024-03-06"), replay.calendar_buckets(orders))
    new = replay.shifted_orders(replay.replayed(orders, templates))
    rows = new.collect()
    assert len(rows) == 8 and len({r.order_id for r in rows}) == 8
    for r in rows:
        assert r.order_approved_at - r.order_purchase_timestamp == dt.timedelta(minutes=5)
        assert r.order_delivered_customer_date - r.order_purchase_timestamp == dt.timedelta(days=3)
        assert r.order_delivered_carrier_date is None and r.is_synthetic
        base = dt.datetime.combine(r.target_date, dt.time(1 + 6 * int(r.template_order_id[-1]), 30))
        assert abs(r.order_purchase_timestamp - base) <= dt.timedelta(minutes=45)
        assert r.batch_id == f"backfill-{r.target_date}" and r.source_template_date.month == 3
    again = replay.shifted_orders(replay.replayed(orders.repartition(7), templates))
    d = differences(new, again).head()
    assert (d.only_left, d.only_right) == (0, 0)
    morning = replay.replayed(orders, templates, hours=(6, 12))
    assert {r.order_id[-1] for r in morning.collect()} == {"1"}


@pytest.mark.parametrize("rate,per_day", [(1.0, 4), (2.0, 8), (2.5, 10), (0.25, 1), (0.01, 1)])
def test_growth_thins_or_repeats(spark, orders, rate, per_day):
    start = "2023-03-05"
    templates = replay.template_dates(targets(spark, "2024-03-04"), replay.calendar_buckets(orders))
    out = replay.grown(replay.replayed(orders, templates), rate, start)
    new = replay.shifted_orders(out)
    assert new.count() == per_day and new.select("order_id").distinct().count() == per_day


def test_children_follow_with_bounded_noise(spark, orders):
    templates = replay.template_dates(targets(spark, "2024-03-05"), replay.calendar_buckets(orders))
    new = replay.shifted_orders(replay.replayed(orders, templates))
    items = orders.select(
        "order_id", F.lit(1).alias("order_item_id"), F.lit("x").alias("product_id"), F.lit("s").alias("seller_id"),
        F.col("order_purchase_timestamp").alias("shipping_limit_date"), F.lit(100).cast("decimal(18,2)").alias("price"),
        F.lit(0.01).cast("decimal(18,2)").alias("freight_value"),
    )
    rows = replay.replayed_items(items, new).collect()
    assert len(rows) == 4 and all(80 < r.price < 120 and float(r.freight_value) == 0.5 for r in rows)
    assert len({r.price for r in rows}) > 1
    shift = {r.order_id: r.order_purchase_timestamp for r in new.collect()}
    assert all(r.shipping_limit_date == shift[r.order_id] for r in rows)
    empty = items.withColumn("price", F.lit(None).cast("decimal(18,2)"))
    assert all(r.price is None for r in replay.replayed_items(empty, new).collect())
    reviews = orders.select(F.concat(F.lit("r"), "order_id").alias("review_id"), "order_id", F.lit(5).alias("review_score"), F.lit("text").alias("review_comment_message"), F.col("order_purchase_timestamp").alias("review_creation_date"), F.col("order_purchase_timestamp").alias("review_answer_timestamp"))
    assert all(r.review_comment_message is None for r in replay.replayed_reviews(reviews, new).collect())
    kept = replay.of_orders(items, orders.where("customer_id = 'c1'"))
    assert kept.count() == 28


def test_customers_repeat_now_and_then(spark, orders):
    templates = replay.template_dates(targets(spark, *[f"2024-03-{d:02d}" for d in range(1, 29)]), replay.calendar_buckets(orders))
    new = replay.shifted_orders(replay.replayed(orders, templates))
    customers = spark.createDataFrame(
        [("c0", "p0", "1", "rio", "RJ", False), ("old", "po", "9", "poa", "RS", True)],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string, is_synthetic boolean",
    )
    named = replay.with_customers(new, customers, rate=0.3).collect()
    repeats = [r for r in named if not r.is_new_customer]
    assert 0.15 < len(repeats) / len(named) < 0.45 and {r.customer_id for r in repeats} == {"old"}
    for r in named:
        if r.is_new_customer:
            known = r.template_customer_id == "c0"
            assert (r.customer_city, r.customer_zip_code_prefix) == (("rio", "1") if known else ("unknown", "0"))
    assert len({r.customer_id for r in named if r.is_new_customer}) == len(named) - len(repeats)
    none = replay.with_customers(new, customers.where("not is_synthetic"), rate=0.9)
    assert none.where("not is_new_customer").count() == 0
