"""Dedup, silver and gold rules on hand-made rows."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from marlake.operators.dedup import differences, latest_per_key, merge_latest
from marlake.plans import features, gold, marts, silver
from marlake.sources.files import keep_first_zip


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def batches(spark):
    return spark.createDataFrame(
        [
            ("a", "historical_x", 1), ("a", "backfill-2024-01-01", 2), ("a", "live-2024-01-01-00-06", 3), ("a", None, 4),
            ("b", None, 5), ("b", "backfill-2024-01-01", 6), ("c", "live-1", 8), ("c", "live-1", 7), ("d", None, 9),
        ],
        "key string, batch_id string, payload int",
    )


def test_latest_batch_wins_as_text_and_nulls_lose(batches):
    got = {r.key: r.payload for r in latest_per_key(batches, ["key"]).collect()}
    assert got == {"a": 3, "b": 6, "c": 7, "d": 9}


def test_dedup_is_idempotent_and_merge_equals_whole(batches):
    once = latest_per_key(batches, ["key"])
    assert differences(once, latest_per_key(once, ["key"])).head().only_left == 0
    early, late = batches.where("payload < 5"), batches.where("payload >= 5")
    d = differences(merge_latest(latest_per_key(early, ["key"]), late, ["key"]), once).head()
    assert (d.only_left, d.only_right, d.left_rows) == (0, 0, 4)


def test_differences_counts_multiplicity(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(1,), (3,)], "a int")
    d = differences(left, right).head()
    assert (d.left_rows, d.right_rows, d.only_left, d.only_right) == (3, 2, 2, 1)


def test_silver_customers_cleans_text(spark):
    bronze = spark.createDataFrame(
        [("c1", "p1", "01234", "  Sao PAULO ", " sp", False, "historical_customers")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string,"
        " customer_state string, is_synthetic boolean, batch_id string",
    )
    r = silver.customers(bronze).head()
    assert (r.customer_zip_code_prefix, r.customer_city, r.customer_state) == ("01234", "sao paulo", "SP")


def test_products_fall_back_to_the_native_name(spark):
    bronze = spark.createDataFrame(
        [("p1", "cama", 1.0, 1.0, 1.0, 1.0), ("p2", "outro", 1.0, 1.0, 1.0, None), ("p3", None, None, 1.0, 1.0, 1.0)],
        "product_id string, product_category_name string, product_weight_g double, product_length_cm double,"
        " product_height_cm double, product_width_cm double",
    )
    translation = spark.createDataFrame([("cama", "bed")], "product_category_name string, product_category_name_english string")
    got = {r.product_id: r.product_category_name_english for r in silver.products(bronze, translation).collect()}
    assert got == {"p1": "bed", "p2": "outro", "p3": None}


def test_geolocation(spark):
    bronze = spark.createDataFrame(
        [("1", 1.0, 2.0, "B", "s"), ("1", 3.0, 4.0, " A ", "s"), ("1", 5.0, 6.0, None, "s"), ("1", 5.0, 6.0, "B", "s")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string,"
        " geolocation_state string",
    )
    r = silver.geolocation(bronze).head()
    assert (r.geolocation_lat, r.geolocation_city, r.geolocation_state) == (3.5, "a", "S")
    mode = silver.geolocation_modes(bronze).head()
    assert (mode.geolocation_city, mode.samples) == ("b", 2)
    assert keep_first_zip(bronze).head().geolocation_lat == 1.0


ORDER = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp,"
    " order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp,"
    " is_synthetic boolean"
)


def order(spark, rows):
    return spark.createDataFrame(
        [
            (i, c, s, ts(p), ts(p), None, d and ts(d), e and ts(e), syn)
            for i, c, s, p, d, e, syn in rows
        ],
        ORDER,
    )


def test_delay_is_three_valued(spark):
    p = "2024-01-01 00:00:00"
    orders = order(
        spark,
        [
            ("late", "c", "delivered", p, "2024-01-05 00:00:01", "2024-01-05 00:00:00", False),
            ("exact", "c", "delivered", p, "2024-01-05 00:00:00", "2024-01-05 00:00:00", False),
            ("undated", "c", "delivered", p, None, "2024-01-05 00:00:00", False),
            ("noestimate", "c", "delivered", p, "2024-01-02 00:59:59", None, False),
            ("open", "x", "shipped", p, "2024-01-09 00:00:00", "2024-01-05 00:00:00", False),
            ("negative", "c", "delivered", p, "2023-12-31 22:30:00", "2024-01-05 00:00:00", False),
        ],
    )
    persons = spark.createDataFrame([("c", "person")], "customer_id string, customer_unique_id string")
    got = {r.order_id: r for r in gold.fct_orders(orders, persons).collect()}
    assert [got[k].is_delayed for k in ("late", "exact", "undated", "noestimate", "open", "negative")] == [
        True, False, None, None, None, False,
    ]
    assert got["late"].delivery_days == 4 and got["noestimate"].delivery_days == 1 and got["negative"].delivery_days == -1 / 24
    assert got["open"].customer_unique_id is None and got["late"].customer_unique_id == "person"


def test_recency_is_per_cohort_with_label_limits(spark):
    days = [0, 90, 91, 180, 181]
    base = dt.datetime(2018, 8, 1, 12)
    rows, customers = [], []
    for i, d in enumerate(days):
        rows.append((f"o{i}", f"c{i}", "delivered", str(base - dt.timedelta(days=d)), None, None, False))
        customers.append((f"c{i}", f"p{i}", "1", "x", "y"))
    rows.append(("s", "cs", "delivered", "2026-01-01 00:00:00", None, None, True))
    rows.append(("o5", "c0b", "delivered", str(base - dt.timedelta(days=700)), None, None, False))
    customers += [("cs", "ps", "1", "x", "y"), ("c0b", "p0", "2", "z", "z")]
    orders = order(spark, rows)
    people = spark.createDataFrame(
        customers,
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    payments = spark.createDataFrame([("o0", 10.0), ("o0", 5.0)], "order_id string, payment_value double").withColumn(
        "payment_value", F.col("payment_value").cast("decimal(18,2)")
    )
    got = {r.customer_unique_id: r for r in gold.dim_customers(people, orders, payments).collect()}
    assert [got[f"p{i}"].recency_days for i in range(5)] == days
    assert [got[f"p{i}"].segment_label for i in range(5)] == ["active", "active", "at_risk", "at_risk", "lost"]
    assert got["ps"].recency_days == 0 and got["ps"].is_synthetic
    assert got["p0"].frequency == 2 and got["p0"].customer_type == "repeat" and float(got["p0"].monetary) == 15
    assert got["p0"].customer_zip_code_prefix == "1" and got["p1"].customer_type == "one_time" and float(got["p1"].monetary) == 0


def test_date_spine_has_no_last_day(spark):
    days = gold.dim_date(gold.date_spine(spark))
    r = days.agg(F.count("*").alias("n"), F.min("date_day").alias("a"), F.max("date_day").alias("b")).head()
    assert (r.n, r.a, r.b) == (5478, dt.date(2016, 1, 1), dt.date(2030, 12, 30))


def test_repeat_label_equals_the_self_join(spark):
    t = [ts(f"2024-01-0{d} 00:00:00") for d in range(1, 5)]
    rows = []
    for person, (a, b, approved) in enumerate(itertools.product(t, t, [*t, None])):
        rows += [
            (f"{person}-1", f"p{person}", a, approved, False),
            (f"{person}-2", f"p{person}", b, None, False),
        ]
    rows.append(("single", "ps", t[1], t[0], False))
    orders = spark.createDataFrame(
        rows, "order_id string, customer_unique_id string, order_purchase_timestamp timestamp, order_approved_at timestamp, is_synthetic boolean"
    )
    items = orders.select("order_id", F.lit(1).alias("order_item_id"), F.lit("x").alias("product_id"), F.lit(1).cast("decimal(18,2)").alias("price"), F.lit(1).cast("decimal(18,2)").alias("freight_value"))
    payments = orders.select("order_id", F.lit(1).alias("payment_sequential"), F.lit("boleto").alias("payment_type"), F.lit(1).alias("payment_installments"), F.lit(1).alias("payment_value"))
    products = spark.createDataFrame([("x", "cat")], "product_id string, product_category_name_english string")
    got = {r.customer_unique_id: r.repeat_purchase for r in marts.repeat_purchase(orders, items, products, payments).collect()}
    people = {}
    for r in rows:
        people.setdefault(r[1], []).append(r)
    for person, own in people.items():
        first = min(own, key=lambda r: (r[2], r[0]))
        cut = first[3] or first[2]
        assert got[person] == int(any(r[0] != first[0] and r[2] > cut for r in own)), person


def test_fan_out_never_multiplies_sums(spark):
    dec = "cast({} as decimal(18,2))"
    orders = order(spark, [("o", "c", "delivered", "2024-01-01 00:00:00", "2024-01-09 00:00:00", "2024-01-05 00:00:00", True)])
    items = spark.createDataFrame([("o", 1, "x", "s1", 10.0), ("o", 2, "x", "s2", 30.0), ("o", 3, "x", "s1", 5.0)], "order_id string, order_item_id int, product_id string, seller_id string, p double").selectExpr("*", f"{dec.format('p')} price", f"{dec.format(1)} freight_value")
    reviews = spark.createDataFrame([("r1", "o", 1), ("r2", "o", 3)], "review_id string, order_id string, review_score bigint")
    payments = spark.createDataFrame([("o", 1, "boleto", 2, 7.0), ("o", 2, "voucher", 1, 9.0)], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    facts = gold.order_facts(orders)
    sold = features.seller_orders(facts, items, reviews)
    exact = {r.seller_id: r for r in features.seller_lifetime_stats(sold).collect()}
    assert float(exact["s1"].revenue) == 15 and float(exact["s2"].revenue) == 30 and exact["s1"].review_raw == 2
    joined = items.join(facts, "order_id").join(reviews, "order_id", "left").groupBy("seller_id").agg(F.sum("price").alias("v"), F.avg("review_score").alias("r"))
    parity = {r.seller_id: r for r in features.seller_lifetime_stats(sold, parity=True).collect()}
    for r in joined.collect():
        assert parity[r.seller_id].revenue == r.v and parity[r.seller_id].review_raw == r.r
    products = spark.createDataFrame([("x", "cat", 2.0)], "product_id string, product_category_name_english string, product_weight_g double")
    persons = orders.withColumn("customer_unique_id", F.lit("p"))
    first = features.first_order_features(persons, items, products, payments).head()
    assert float(first.first_order_price) == 45 and first.first_order_n_items == 3 and first.first_order_n_sellers == 2
    assert first.payment_type == "boleto" and first.first_order_main_category == "cat" and first.first_order_weight == 6


def test_open_orders_leave_out_unknown_status(spark):
    df = spark.createDataFrame([("a", "shipped"), ("b", "delivered"), ("c", None), ("d", "canceled")], "order_id string, order_status string")
    assert [r.order_id for r in features.open_orders(df).collect()] == ["a"]


def test_impute(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "x double")
    assert sorted(r.x for r in features.impute(df, "x").collect()) == [1, 2, 2, 9]
    assert sorted(r.x for r in features.impute(df, "x", fill=0.0).collect()) == [0, 1, 2, 9]
