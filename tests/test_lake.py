"""CSV scans, layered tables, state, incremental runs and streams."""

import datetime as dt
import re
import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marlake.operators.dedup import differences, latest_per_key
from marlake.plans import gold, marts, silver
from marlake.sources import files
from marlake.sources.lake import Lake, Part, add_columns_union, bucket_of, synthetic_pool
from marlake.streaming import incremental, live, revenue, windows


def ts(text):
    return dt.datetime.fromisoformat(text)


def utc(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


# --- CSV ------------------------------------------------------------------------------------
def test_csv_text(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        '﻿review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
        'r1,o1,5,,"two\nlines, and ""quotes""",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        'r2,o2,1,"t",,2018-03-10 00:00:00,\n',
        encoding="utf-8",
    )
    rows = files.read_raw(spark, "order_reviews", str(path)).orderBy("review_id").collect()
    assert rows[0].review_comment_message == 'two\nlines, and "quotes"' and rows[0].review_comment_title is None
    assert rows[0].review_answer_timestamp == ts("2018-01-18 21:46:59") and rows[1].review_answer_timestamp is None
    assert [r.review_score for r in rows] == [5, 1]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("extra,seller_state,seller_id,seller_city,seller_zip_code_prefix\nx,SP,s1,rio,01234\n")
    r = files.read_raw(spark, "sellers", str(path)).head()
    assert (r.seller_id, r.seller_zip_code_prefix, r.seller_state) == ("s1", "01234", "SP")


def test_bad_number_is_an_error(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\no,1,boleto,1,abc\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_raw(spark, "order_payments", str(path)).collect()


# --- tables ---------------------------------------------------------------------------------
def test_batches_are_written_once(spark, lake):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert lake.append_new_batch("bronze", "t", df, "live-1")
    assert not lake.append_new_batch("bronze", "t", df, "live-1")
    assert not lake.append_new_batch("bronze", "t", df.limit(0), "live-2")
    assert lake.append_new_batch("bronze", "t", df.limit(1), "2024")
    assert lake.loaded_batches("bronze", "t", ["live-1", "2024", "nope"]) == ["2024", "live-1"]
    assert lake.read("bronze", "t").count() == 3


def test_batch_written_again_replaces_itself_only(spark, lake):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, batch_id string")
    lake.write_batches("bronze", "t", df)
    lake.write_batches("bronze", "t", spark.createDataFrame([("c", "x")], df.schema))
    assert {(r.k, r.batch_id) for r in lake.read("bronze", "t").collect()} == {("c", "x"), ("b", "y")}
    lake.compact_batch("bronze", "t", "x")
    assert lake.read("bronze", "t", ["x"]).head().k == "c"


def test_new_columns_join_the_table(spark, lake):
    lake.write_batches("bronze", "t", spark.createDataFrame([("a", "x")], "k string, batch_id string"))
    lake.write_batches("bronze", "t", spark.createDataFrame([("b", 5, "y")], "k string, extra int, batch_id string"))
    assert {(r.k, r.extra) for r in lake.read("bronze", "t").collect()} == {("a", None), ("b", 5)}
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("1",)], "a string")
    with pytest.raises(TypeError):
        add_columns_union(old, new)


def test_batch_filter_prunes_partitions(spark, lake):
    lake.write_batches("bronze", "t", spark.createDataFrame([("a", "x"), ("b", "y")], "k string, batch_id string"))
    plan = lake.read("bronze", "t", ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_load_once(spark, lake):
    df = spark.createDataFrame([(1,)], "a int")
    assert lake.load_once("raw", "t", df) and not lake.load_once("raw", "t", df)
    assert lake.load_once("raw", "t", df.union(df), force=True) and lake.read("raw", "t").count() == 2


def test_published_versions_and_scores(spark, lake):
    assert lake.current("predictions", "risk") is None
    df = spark.createDataFrame([(1,)], "a int")
    assert lake.publish_scores("risk", df)
    assert not lake.publish_scores("risk", df.limit(0))
    assert lake.current("predictions", "risk").head().a == 1
    again = lake.current("predictions", "risk").drop("scored_at").withColumn("a", F.col("a") + 1)
    assert lake.publish_scores("risk", again)
    row = lake.current("predictions", "risk").head()
    assert row.a == 2 and row.scored_at is not None


def test_state(lake):
    assert lake.get_state("p") is None
    lake.set_state("p", utc("2024-01-02 00:00:00"), utc("2024-05-01 00:00:00"))
    lake.set_state("p", utc("2024-01-01 00:00:00"), utc("2024-05-02 00:00:00"))
    lake.set_state("q", utc("2025-01-01 00:00:00"))
    assert lake.get_state("p").replace(tzinfo=None) == ts("2024-01-01 00:00:00")


def test_pool_holds_all_synthetic_customers(spark):
    df = spark.range(30).selectExpr(
        "lpad(cast(id as string), 3, '0') customer_id", "'p' customer_unique_id", "'1' customer_zip_code_prefix",
        "'c' customer_city", "'s' customer_state", "id % 2 = 0 is_synthetic",
    )
    assert sorted(r.customer_id for r in synthetic_pool(df).collect()) == [f"{i:03d}" for i in range(0, 30, 2)]


def test_reconcile(spark):
    a, b = spark.range(3), spark.range(2)
    got = {r.table_name: r.matches for r in files.reconcile({"x": a, "y": a}, {"x": a, "y": b}).collect()}
    assert got == {"x": True, "y": False}


# --- windows --------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "last,bound,count,first",
    [
        ("2024-01-01 23:59:59.999999", "2024-01-02 13:00:00", 2, "live-2024-01-02-00-06"),
        ("2024-01-02 06:00:00", "2024-01-03 00:00:00", 3, "live-2024-01-02-06-12"),
        ("2024-01-02 06:00:00", "2024-01-02 11:59:59", 0, None),
        ("2024-01-05 00:00:00", "2024-01-02 00:00:00", 0, None),
        ("2024-01-02 18:00:00", "2024-01-03 00:00:00", 1, "live-2024-01-02-18-24"),
    ],
)
def test_pending_windows(spark, last, bound, count, first):
    states = spark.createDataFrame([("p", ts(last), ts(bound))], "pipeline_name string, last_processed_at timestamp, upper_bound timestamp")
    rows = windows.pending_windows(states).orderBy("window_start").collect()
    plain = windows.windows_between(ts(last), ts(bound))
    assert len(rows) == count and [r.batch_id for r in rows] == [b for _, _, b in plain]
    if first:
        assert rows[0].batch_id == first
        assert rows[0].window_start.replace(tzinfo=None) == plain[0][0]


def test_pending_days(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3, 4)], "day date")
    loaded = spark.createDataFrame([("backfill-2024-01-02",)], "batch_id string")
    got = windows.pending_days(days, loaded, "2024-01-02").collect()
    assert [str(r.day) for r in got] == ["2024-01-03", "2024-01-04"]


# --- incremental ----------------------------------------------------------------------------
ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp,"
    " order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp,"
    " is_synthetic boolean, source_template_date date, batch_id string"
)


def bronze_orders(spark, rows):
    t = ts("2024-01-01 01:00:00")
    return spark.createDataFrame(
        [(o, c, s, t, None, None, t + dt.timedelta(hours=h), t, True, None, b) for o, c, s, h, b in rows], ORDERS
    )


def bronze_customers(spark, rows):
    return spark.createDataFrame(
        [(c, p, "1", "x", "y", True, b) for c, p, b in rows],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string,"
        " customer_state string, is_synthetic boolean, batch_id string",
    )


B = [f"live-2024-01-01-{h:02d}-{h + 6:02d}" for h in (0, 6, 12, 18)]


def full_build(lake):
    customers = silver.customers(lake.read("bronze", "bronze_customers"))
    orders = silver.orders(lake.read("bronze", "bronze_orders"))
    return gold.fct_orders(orders, customers)


def same(lake):
    d = differences(full_build(lake), lake.read("gold", "fct_orders").select(*full_build(lake).columns)).head()
    return d.only_left == 0 and d.only_right == 0


def test_incremental_equals_rebuild_with_keys_that_return(spark, lake):
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [("c1", "p1", B[0]), ("c2", "p2", B[1])]))
    lake.write_batches(
        "bronze", "bronze_orders",
        bronze_orders(spark, [
            ("o1", "c1", "created", 5, B[0]), ("o2", "c1", "delivered", 30, B[0]), ("o3", "c2", "delivered", 49, B[1]),
            ("o1", "c1", "delivered", 26, B[2]), ("o3", "c2", "delivered", 50, B[2]), ("o3", "c2", "canceled", 50, B[3]),
        ]),
    )
    incremental.bootstrap(lake, utc("2024-01-01 00:00:00"))
    lake.set_state(incremental.INGEST, utc("2024-01-01 12:00:00"))
    assert incremental.run_pending(lake) == B[:2]
    assert incremental.run_pending(lake) == []
    lake.set_state(incremental.INGEST, utc("2024-01-02 00:00:00"))
    assert incremental.run_pending(lake) == B[2:]
    assert same(lake)
    rows = {r.order_id: (r.order_status, r.batch_id) for r in lake.read("gold", "fct_orders").collect()}
    assert rows == {"o1": ("delivered", B[2]), "o2": ("delivered", B[0]), "o3": ("canceled", B[3])}
    # The batch whose only order moved on is gone from both layers.
    assert lake.loaded_batches("silver", "silver_orders", B) == [B[0], B[2], B[3]]
    assert lake.loaded_batches("gold", "fct_orders", B) == [B[0], B[2], B[3]]


def test_rows_without_a_batch_are_a_batch_of_their_own(spark, lake):
    """A key first stored without a batch id and coming again leaves no second row."""
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [("c1", "p1", None), ("c2", "p2", B[1])]))
    first = [("o1", "c1", "created", 5, None), ("o2", "c1", "shipped", 5, None)]
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, first))
    incremental.process_batches(lake, [None])
    assert lake.read("gold", "fct_orders").count() == 2 and same(lake)
    again = [("o1", "c1", "delivered", 9, B[1]), ("o3", "c2", "created", 9, B[1])]
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, again))
    incremental.process_batches(lake, [B[1]])
    assert same(lake)
    rows = {r.order_id: (r.order_status, r.batch_id) for r in lake.read("gold", "fct_orders").collect()}
    assert rows == {"o1": ("delivered", B[1]), "o2": ("shipped", None), "o3": ("created", B[1])}
    incremental.process_batches(lake, [None, B[1]])
    assert same(lake)


def test_batches_can_be_processed_again_and_one_by_one(spark, lake):
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [("c1", "p1", B[0])]))
    lake.write_batches(
        "bronze", "bronze_orders",
        bronze_orders(spark, [("o1", "c1", "created", 5, B[0]), ("o1", "c1", "delivered", 9, B[1]), ("o2", "c9", "shipped", 9, B[1])]),
    )
    for batch in [B[0], B[1], B[0], B[1]]:
        incremental.process_batches(lake, [batch])
        assert not lake.read("silver", "silver_orders").groupBy("order_id").count().where("count > 1").count()
    assert same(lake)


def test_a_run_interrupted_before_the_facts_resumes(spark, lake):
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [("c1", "p1", B[0])]))
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, [("o1", "c1", "delivered", 5, B[0])]))
    incremental.upsert_batches(lake, "orders", silver.orders(lake.read("bronze", "bronze_orders", [B[0]])))
    incremental.process_batches(lake, [B[0]])
    assert same(lake)


def test_an_interrupted_run_leaves_no_outdated_facts(spark, lake):
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [("c1", "p1", B[0])]))
    lake.write_batches(
        "bronze", "bronze_orders",
        bronze_orders(spark, [("o1", "c1", "created", 5, B[0]), ("o2", "c1", "shipped", 5, B[0]), ("o1", "c1", "delivered", 9, B[1])]),
    )
    incremental.process_batches(lake, [B[0]])
    # Silver has moved on, the run ends before the facts, and is started again.
    incremental.upsert_batches(lake, "orders", silver.orders(lake.read("bronze", "bronze_orders", [B[1]])))
    incremental.process_batches(lake, [B[1]])
    assert same(lake)


def test_a_batch_looks_into_the_buckets_of_its_keys_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=8)
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [(f"c{i}", f"p{i}", B[0]) for i in range(40)]))
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, [(f"o{i}", f"c{i}", "created", 5, B[0]) for i in range(40)]))
    incremental.process_batches(lake, [B[0]])
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, [("o3", "c3", "delivered", 9, B[1])]))
    own = spark.createDataFrame([("o3",)], "order_id string").select(bucket_of(["order_id"], 8)).first()[0]
    files = {f: f for f in lake.read("silver", "silver_orders").inputFiles()}
    touched = incremental.process_batches(lake, [B[1]])
    for table in ("orders", "fct_orders"):
        assert touched[table].read == [Part(B[0], own)] and touched[table].rewritten == [Part(B[0], own), Part(B[1], own)]
    # Files of the other buckets are the same ones as before.
    after = set(lake.read("silver", "silver_orders").inputFiles())
    assert {f for f in files if f"key_bucket={own}/" not in f} <= after
    scan = lake.read("gold", "fct_orders", parts=[Part(B[0], own)])
    assert all(f"key_bucket={own}/" in f for f in scan.inputFiles()) and len(scan.inputFiles()) == 1
    assert {r.order_status for r in lake.read("gold", "fct_orders").where("order_id = 'o3'").collect()} == {"delivered"}
    assert same(lake)


def test_the_log_tells_schema_and_partitions(spark, lake, monkeypatch):
    lake.write_batches("bronze", "t", spark.createDataFrame([("a", "x/1"), ("b", None)], "k string, batch_id string"))
    lake.write_batches("bronze", "t", spark.createDataFrame([("c", 5, "007")], "k string, extra int, batch_id string"))
    assert [p.batch for p in lake.parts("bronze", "t")] == [None, "007", "x/1"]
    one = lake.read("bronze", "t", ["x/1"])
    assert one.columns == ["k", "extra", "batch_id"] and [tuple(r) for r in one.collect()] == [("a", None, "x/1")]
    assert len(one.inputFiles()) == 1
    with pytest.raises(TypeError):
        lake.write_batches("bronze", "t", spark.createDataFrame([(1, "z")], "k int, batch_id string"))
    other = Lake(spark, lake.root)  # another session sees the same log
    other.remove_batches("bronze", "t", [None, "x/1"])
    assert [tuple(r) for r in lake.read("bronze", "t").collect()] == [("c", 5, "007")]


def items(spark, rows):
    return spark.createDataFrame(
        [(o, i, "p", "s", ts("2024-01-01 00:00:00"), Decimal(price), Decimal(1), True, b) for o, i, price, b in rows],
        "order_id string, order_item_id long, product_id string, seller_id string, shipping_limit_date timestamp, price decimal(18,2),"
        " freight_value decimal(18,2), is_synthetic boolean, batch_id string",
    )


def test_revenue_state_follows_returns_repeats_and_interruptions(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [("c1", "p1", B[0])]))
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, [("o1", "c1", "created", 5, B[0]), ("o2", "c1", "created", 5, B[0])]))
    lake.write_batches("bronze", "bronze_order_items", items(spark, [("o1", 1, 10, B[0]), ("o1", 2, 5, B[0]), ("o2", 1, 7, B[0])]))

    def counted():
        rows = revenue.current(lake).collect()
        whole = marts.daily_revenue(lake.read("gold", "fct_orders"), lake.read("gold", "fct_order_items")).collect()
        key = lambda r: (r.date_day, r.is_synthetic, r.order_count, float(r.total_product_revenue), float(r.total_revenue))
        assert sorted(map(key, rows)) == sorted(map(key, whole))
        return [(r.order_count, float(r.total_product_revenue)) for r in rows]

    incremental.process_batches(lake, [B[0]])
    assert counted() == [(2, 22.0)]
    lake.write_batches("bronze", "bronze_order_items", items(spark, [("o1", 1, 4, B[1]), ("o3", 1, 9, B[1])]))
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, [("o3", "c1", "created", 5, B[1])]))
    finish = revenue.finish
    monkeypatch.setattr(revenue, "finish", lambda lake, run: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        incremental.process_batches(lake, [B[1]])
    monkeypatch.setattr(revenue, "finish", finish)
    incremental.process_batches(lake, [B[1]])
    assert counted() == [(3, 25.0)]
    revenue.compact(lake)
    assert counted() == [(3, 25.0)] and len(revenue.entries(lake)) == 1


@pytest.mark.parametrize("least", [0, incremental.FILE_LEAST])
def test_batches_go_into_the_lake_without_a_copy_beside_it(spark, tmp_path, monkeypatch, least):
    """Rows that return are merged with what the table has in the write that replaces it, for many and for few rows."""
    monkeypatch.setattr(incremental, "FILE_LEAST", least)
    copied, stage = [], incremental.stage
    monkeypatch.setattr(incremental, "stage", lambda df, name: copied.append(name) or stage(df, name))
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    lake.write_batches("bronze", "bronze_customers", bronze_customers(spark, [(f"c{i}", f"p{i}", B[0]) for i in range(9)]), settled=True)
    first = [(f"o{i}", f"c{i}", "created", 5, B[0]) for i in range(9)] + [("o1", "c1", "shipped", 5, B[1]), ("o1", "c1", "created", 5, B[1])]
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, first), settled=True)
    incremental.process_batches(lake, B[:2])
    again = [(f"o{i}", f"c{i}", "delivered", 9, B[2]) for i in range(0, 9, 2)] + [("o9", "c1", "created", 9, B[2])]
    lake.write_batches("bronze", "bronze_orders", bronze_orders(spark, again))
    for _ in range(2):
        incremental.process_batches(lake, [B[2]])
        assert same(lake) and lake.read("gold", "fct_orders").count() == 10
    assert lake.read("silver", "silver_orders").where("order_status = 'delivered'").count() == 5
    assert {r.order_status for r in lake.read("silver", "silver_orders").where("order_id = 'o1'").collect()} == {"created"}
    assert {name.split("-")[0] for name in copied} <= {"repeated"}  # keys that came twice, no rows


@pytest.mark.parametrize("few", [0, 2, incremental.FEW_KEYS])
@pytest.mark.parametrize("least", [0, incremental.FILE_LEAST])
def test_rows_without_a_twin_go_straight_into_silver(spark, tmp_path, monkeypatch, few, least):
    """No, few or many keys that come more than once, a missing key among them: always the silver rows of all bronze."""
    monkeypatch.setattr(incremental, "FEW_KEYS", few)
    monkeypatch.setattr(incremental, "FILE_LEAST", least)
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    runs = [
        [(f"o{i}", 1, i, B[1]) for i in range(20)],
        [("o1", 1, 7, B[0]), ("o1", 1, 8, B[0]), ("o2", 1, 9, B[0]), (None, 1, 3, B[0]), (None, 1, 2, B[0])],
        [("o3", 1, 7, B[2]), ("o3", 1, 6, B[2]), ("o4", 1, 6, B[2]), ("o4", 1, 6, B[2]), ("o5", 1, 6, B[2]), ("o5", 2, 6, B[2]), (None, 1, 1, B[2]), (None, 1, 4, B[2])],
        [(f"o{i}", 1, 50 + i, B[3]) for i in range(0, 20, 3)],
    ]
    for k, rows in enumerate(runs):
        lake.write_batches("bronze", "bronze_order_items", items(spark, rows))
        bronze = lake.read("bronze", "bronze_order_items", [rows[0][3]])
        incremental.upsert_arrived(lake, "order_items", bronze)
        whole = silver.order_items(lake.read("bronze", "bronze_order_items"))
        keyed = lambda df: df.where("order_id is not null")
        d = differences(keyed(lake.read("silver", "silver_order_items").select(whole.columns)), keyed(whole)).head()
        assert d.only_left == d.only_right == 0 and d.left_rows == d.right_rows, k
    assert lake.read("silver", "silver_order_items", [B[2]]).where("order_id is null").count() == 1


def test_shuffle_files_go_when_a_batch_is_written(spark, lake):
    before = len(list_shuffles(spark))
    rows = spark.range(2000).selectExpr("cast(id as string) k", "'x' batch_id").repartition(5, "k")
    lake.write_batches("bronze", "t", rows)
    for _ in range(50):
        if len(list_shuffles(spark)) <= before:
            break
        time.sleep(0.2)
    assert len(list_shuffles(spark)) <= before


def list_shuffles(spark):
    """Shuffle data files that the session has on its disks."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return [f for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*.data")]


def test_rows_are_compared_where_their_keys_lie(spark):
    raw = spark.range(500).selectExpr("cast(id % 300 as string) order_id", "id % 3 order_item_id", "cast(id % 7 as string) batch_id", "id v")
    right = latest_per_key(raw, ["order_id", "order_item_id"])
    left = right.where("v % 5 <> 0").unionByName(right.where("v % 5 = 1")).localCheckpoint()
    plain, dealt = differences(left, right), differences(left, right, ["order_id", "order_item_id"])
    assert dealt.head() == plain.head() and dealt.head().only_left > 0 and dealt.head().only_right > 0
    plan = dealt._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[-1]
    # Each side is dealt out once by key, and neither by whole rows.
    assert plan.count("Exchange hashpartitioning(order_id") == 2 and plan.count("Exchange hashpartitioning") == 2
    assert not re.search(r"hashpartitioning\([^)]*batch_id", plan)


def test_cursors_are_required(lake):
    with pytest.raises(RuntimeError):
        incremental.run_pending(lake)


# --- streams --------------------------------------------------------------------------------
def write_parts(spark, folder, parts):
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{folder}/{i}")


def test_stream_counts_over_several_batches(spark, tmp_path):
    schema = "event_id long, ts timestamp, kind string"
    parts = [
        [(1, ts("2024-01-01 01:00:00"), "a"), (2, ts("2024-01-01 07:00:00"), "a")],
        [(3, ts("2024-01-09 01:00:00"), "b")],
        [(4, ts("2024-01-01 02:00:00"), "a")],
    ]
    frames = [spark.createDataFrame(p, schema) for p in parts]
    write_parts(spark, tmp_path / "in", frames)
    source = live.read_files(spark, f"{tmp_path}/in/*", frames[0].schema, files_per_batch=1)
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    live.write_window_deltas(source, "ts", ["kind"], target, state).awaitTermination()
    live.write_window_deltas(source, "ts", ["kind"], target, state).awaitTermination()
    totals = live.window_totals(spark.read.parquet(target), ["kind"])
    got = {(r.batch_id, r.kind): r.n for r in totals.collect()}
    # The row eight days late still counts.
    assert got == {("live-2024-01-01-00-06", "a"): 2, ("live-2024-01-01-06-12", "a"): 1, ("live-2024-01-09-00-06", "b"): 1}


def test_closed_windows_are_handed_on_once(spark, tmp_path):
    schema = "event_id long, ts timestamp, kind string"
    parts = [[(i, ts(t), "a")] for i, t in enumerate(["2024-01-01 01:00:00", "2024-01-01 02:00:00", "2024-01-02 09:00:00"])]
    frames = [spark.createDataFrame(p, schema) for p in parts]
    write_parts(spark, tmp_path / "in", frames)
    source = live.read_files(spark, f"{tmp_path}/in/*", frames[0].schema, files_per_batch=1)
    query = (
        live.closed_window_counts(source, "ts", ["kind"])
        .writeStream.format("memory").queryName("closed_windows").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.table("closed_windows").collect()
    assert [(r.batch_id, r.n) for r in rows] == [("live-2024-01-01-00-06", 2)]


def test_stream_ingest_keeps_one_row_per_key(spark, lake, tmp_path):
    t1, t2 = ts("2024-01-01 01:00:00"), ts("2024-01-01 02:00:00")

    def part(rows):
        return spark.createDataFrame(
            [(o, "c", s, t, None, None, None, None, True, None) for o, s, t in rows], ORDERS.replace(", batch_id string", "")
        )

    frames = [part([("o1", "created", t1), ("o2", "created", t1)]), part([("o3", "created", t2), ("o1", "created", t1)]), part([("o2", "created", t1)])]
    write_parts(spark, tmp_path / "in", frames)
    source = live.read_files(spark, f"{tmp_path}/in/*", frames[0].schema, files_per_batch=1)
    live.ingest(source, "order_purchase_timestamp", lake, "orders", silver.orders, str(tmp_path / "s")).awaitTermination()
    rows = lake.read("silver", "silver_orders").collect()
    assert sorted(r.order_id for r in rows) == ["o1", "o2", "o3"] and {r.batch_id for r in rows} == {B[0]}


# --- raw files ------------------------------------------------------------------------------
TRANSLATION = "product_category_name,product_category_name_english\n"


def test_csv_lines_must_fit_the_header(spark, tmp_path):
    (tmp_path / "good.csv").write_text(TRANSLATION + 'a,"x, y"\n')
    rows = files.read_raw(spark, "category_translation", str(tmp_path / "good.csv")).collect()
    assert [tuple(r) for r in rows] == [("a", "x, y")]
    for name, line in (("short", "a\n"), ("long", "a,b,c\n")):
        (tmp_path / f"{name}.csv").write_text(TRANSLATION + line)
        with pytest.raises(Exception, match="(?i)malformed|corrupt|FAILED_READ"):
            files.read_raw(spark, "category_translation", str(tmp_path / f"{name}.csv")).collect()


def test_csv_files_with_another_column_order_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text(TRANSLATION + "a,b\n")
    (tmp_path / "2.csv").write_text("product_category_name_english,product_category_name\nb,a\n" * 1)
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_raw(spark, "category_translation", str(tmp_path)).collect()
    only = files.read_raw(spark, "category_translation", str(tmp_path / "2.csv")).collect()
    assert [tuple(r) for r in only] == [("a", "b")]
