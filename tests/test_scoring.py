import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlake.operators import quality
from marlake.plans import ml, profiling, reports, scoring


@pytest.mark.parametrize("n", [1, 2, 3, 20, 101])
@pytest.mark.parametrize("equal", [False, True])
def test_tiers_match_qcut(spark, many_chunks, n, equal):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"k": [f"{i:04d}" for i in range(n)], "s": np.zeros(n) if equal else rng.integers(0, 9, n) / 9})
    df = spark.createDataFrame([(r.k, float(r.s)) for r in pdf.itertuples()], "k string, s double")
    got = scoring.risk_tiers(df, "s", "k").toPandas().set_index("k").risk_tier.sort_index()
    if n == 1:
        assert list(got) == ["Low"]
        return
    ranks = pdf.sort_values(["s", "k"]).reset_index(drop=True)
    want = pd.qcut(pd.Series(range(1, n + 1)), [0, 0.5, 0.8, 0.95, 1.0], labels=["Low", "Medium", "High", "Critical"])
    ranks["tier"] = want.astype(str)
    assert list(got) == list(ranks.set_index("k").sort_index().tier)


def test_actions_first_rule_wins(spark):
    rows = [(f"c{i}", s, float(v)) for i, (s, v) in enumerate(
        [("Lapsed & High-Value", 100), ("Lapsed & High-Value", 1), ("Lapsed & Low-Value", 1), ("Lapsed & Low-Value", 50), ("Recent & High-Value", 100), ("Lapsed & Low-Value", 90)]
    )]
    df = spark.createDataFrame(rows, "customer_unique_id string, segment string, predicted_incremental_value double")
    got = [r.suggested_action for r in scoring.suggested_action(df).orderBy("customer_unique_id").collect()]
    values = pd.Series([r[2] for r in rows])
    hi, lo = values.quantile(0.66), values.quantile(0.33)

    def rule(segment, v):
        lapsed = segment.startswith("Lapsed")
        if lapsed and v >= hi:
            return scoring.ACTION_VOUCHER
        if segment == "Lapsed & High-Value":
            return scoring.ACTION_WIN_BACK
        return scoring.ACTION_EMAIL if lapsed and v <= lo else scoring.ACTION_NONE

    assert got == [rule(s, v) for _, s, v in rows]


def test_cluster_names(spark):
    df = spark.createDataFrame(
        [(0, 10.0, 500.0), (1, 300.0, 400.0), (2, 200.0, 10.0), (2, 210.0, 12.0)], "cluster int, recency double, monetary double"
    )
    labels = scoring.customer_cluster_labels(df)
    got = {r.cluster: r.segment for r in labels.collect()}
    assert got == {0: "Recent & High-Value", 1: "Lapsed & High-Value", 2: "Recent & Modest-Spend"}
    unnamed = scoring.name_clusters(spark.createDataFrame([(7,)], "cluster int"), labels).head().segment
    assert unnamed == "cluster_7"


def test_tier_order_and_lists(spark):
    df = spark.createDataFrame([("a", 0.9, "Low"), ("b", 0.9, "Critical"), ("c", 0.1, "High")], "k string, s double, risk_tier string")
    assert [r.k for r in reports.top_list(df, "s", "k", limit=2).collect()] == ["a", "b"]
    assert [r.k for r in reports.top_list(df, "s", "k", "risk_tier", "Low' or '1'='1").collect()] == []
    assert [r.risk_tier for r in reports.tier_summary(df).collect()] == ["Critical", "High", "Low"]


def test_trend_without_forecast(spark):
    trend = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 2.0)], "ds date, orders long, revenue double")
    assert reports.trend_with_forecast(trend, None).head().yhat is None


def test_gaps_are_filled_and_spikes_found(spark):
    days = ["2024-01-01", "2024-01-01", "2024-01-03", "2024-04-30"]
    orders = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days] + [(None,)], "order_purchase_timestamp timestamp")
    daily = {str(r.day): r.orders for r in profiling.daily_volume(orders).collect()}
    assert daily["2024-01-02"] == 0 and len(daily) == 121 and sum(daily.values()) == 4
    monthly = profiling.monthly_volume(orders)
    assert [r.orders for r in monthly.orderBy("month").collect()] == [3, 0, 0, 1]
    assert [str(r.month) for r in profiling.spike_months(monthly, 1.5).collect()] == ["2024-01-01"]
    flat = spark.createDataFrame([(1, 5), (2, 5)], "month int, orders long")
    assert profiling.spike_months(flat).count() == 0
    assert profiling.spike_months(flat.limit(1), 0).count() == 0
    assert profiling.order_profile(orders).head().missing_timestamps == 1


def test_summary_document_is_one_json_row(spark, tmp_path):
    orders = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 3, 1),)], "order_purchase_timestamp timestamp")
    items = spark.createDataFrame([(1.0,), (3.0,)], "price double")
    doc = profiling.summary_document(orders, items)
    doc.write.json(str(tmp_path / "doc"))
    back = spark.read.json(str(tmp_path / "doc")).head()
    assert back.orders.total_orders == 2 and back.price.p50 == 2.0
    assert back.monthly_order_counts["2024-02-01"] == 0


def test_approximate_pack_is_close(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"))
    r = profiling.approx_quantile_pack(df, "x").head()
    assert abs(r.p50 - 5000) < 20 and abs(r.p95 - 9500) < 20


def test_quality_checks(spark):
    child = spark.createDataFrame([("a", 1), ("a", 1), ("zz", 9), (None, None)], "k string, v int")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    checks = quality.report(
        [
            quality.not_null(child, "t", ["k", "v"]),
            quality.unique(child, "t", "k"),
            quality.accepted_values(child, "t", "v", [1, 2]),
            quality.relationships(child, "t", "k", parent, "k"),
        ]
    )
    got = {(r.column_name, r.check_name): (r.failures, r.checked) for r in checks.collect()}
    assert got[("k", "not_null")] == (1, 4) and got[("v", "not_null")] == (1, 4)
    assert got[("k", "unique")] == (1, 3) and got[("v", "accepted_values")] == (1, 4)
    assert got[("k", "relationships")] == (1, 4)


# --- models ---------------------------------------------------------------------------------
def sample(spark, n=400):
    return spark.range(n).selectExpr(
        "id", "cast(id % 17 as double) a", "case when id % 13 = 0 then null else cast(id % 5 as double) end b",
        "case when id % 11 = 0 then null else concat('c', id % 3) end c", "cast(id % 17 > 12 as int) y",
    )


def test_classifier_scores_are_probabilities(spark):
    df = sample(spark)
    model = ml.fit_classifier(df, "y", ["a", "b"], ["c"], maxIter=3, maxDepth=3)
    new = df.withColumn("c", F.when(F.col("id") < 5, F.lit("never seen")).otherwise(F.col("c")))
    rows = ml.score(model, new, ["a", "b"], ["c"], "p").collect()
    assert len(rows) == 400 and all(0 <= r.p <= 1 for r in rows)
    assert np.mean([r.p for r in rows if r.y]) > np.mean([r.p for r in rows if not r.y])


def test_unknown_category_is_all_zeros(spark):
    from pyspark.ml import Pipeline

    df = ml.prepared(sample(spark), ["a"], ["c"])
    model = Pipeline(stages=ml.preprocessing(["a"], ["c"], scale=False)).fit(df)
    row = model.transform(df.limit(1).withColumn("c", F.lit("new"))).head()
    assert list(row.features)[1:] == [0.0] * (len(row.features) - 1) and len(row.features) == 5


def test_value_model_is_never_negative(spark):
    df = sample(spark).withColumn("y", F.log1p(F.col("a") * 3))
    model = ml.fit_value_model(df, "y", ["a", "b"], ["c"], maxIter=3)
    assert all(r.v >= 0 for r in ml.predict_value(model, df, ["a", "b"], ["c"], "v").collect())


def test_clusters_and_elbow(spark):
    df = spark.range(300).selectExpr("id", "cast(id % 3 * 10 + id % 2 as double) x", "cast(id % 3 as double) y")
    model = ml.fit_clusters(df, ["x", "y"], starts=2)
    pairs = ml.assign_clusters(model, df).selectExpr("id % 3 g", "cluster").distinct().collect()
    assert len(pairs) == 3 and len({p.cluster for p in pairs}) == 3
    costs = [r.training_cost for r in ml.elbow(df, ["x", "y"], ks=[2, 3], starts=2).orderBy("k").collect()]
    assert costs[1] < costs[0]


def test_split_is_stratified_and_stable(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 10 = 0 as int) y")
    a = ml.stratified_split(df, "y", "id")
    counts = {(r.y, r.is_test): r["count"] for r in a.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, True): 180, (0, False): 720, (1, True): 20, (1, False): 80}
    b = ml.stratified_split(df.orderBy(F.desc("id")), "y", "id")
    assert a.where("is_test").select("id").exceptAll(b.where("is_test").select("id")).count() == 0


def test_evaluation_against_hand_counts(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2), (1, 0.2), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    report = {r["class"]: r for r in ml.classification_report(df, "y", "s").collect()}
    assert report[1].precision == pytest.approx(2 / 3) and report[1].recall == pytest.approx(2 / 3) and report[1].support == 3
    points = ml.precision_recall_points(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert [p.threshold for p in points] == [0.9, 0.8, 0.7, 0.2, 0.1]
    assert points[3].precision == pytest.approx(3 / 5) and points[3].recall == 1.0
    ap = ml.average_precision(ml.precision_recall_points(df, "y", "s")).head()[0]
    assert ap == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5)


def test_holiday_rules():
    assert ml.black_friday(2017) == dt.date(2017, 11, 24) and ml.black_friday(2024) == dt.date(2024, 11, 29)
    assert ml.mothers_day(2018) == dt.date(2018, 5, 13) and ml.mothers_day(2025) == dt.date(2025, 5, 11)
    assert ml.carnival(2018) == dt.date(2018, 2, 13) and ml.carnival(2025) == dt.date(2025, 3, 4)


def test_forecast_follows_trend_and_week(spark):
    daily = spark.range(730).selectExpr("date_add(date'2022-01-01', cast(id as int)) ds", "100 + id * 0.5 + case when (id + 6) % 7 < 2 then 40 else 0 end y")
    days = ml.holiday_days(ml.holiday_calendar(spark, [2022, 2023, 2024]))
    out = ml.forecast(daily, days).orderBy("ds").collect()
    assert len(out) == 90 and out[0].ds == dt.date(2024, 1, 1)
    assert all(0 <= r.yhat_lower <= r.yhat <= r.yhat_upper for r in out)
    want = [100 + (730 + i) * 0.5 + (40 if (736 + i) % 7 < 2 else 0) for i in range(90)]
    assert np.mean(np.abs(np.array([r.yhat for r in out]) - want)) < 15


def test_stored_parameters_give_the_models_results(spark):
    rows = [(i, float(i % 7) if i % 11 else None, float(i * i % 13), ["x", "y", None][i % 3], int(i % 5 < 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c string, y int")
    model = ml.fit_logistic(df, "y", ["a", "b"], ["c"])
    learned = ml.parameter_rows(model, ["a", "b"], ["c"])
    new = df.union(spark.createDataFrame([(900, None, None, "never seen", 0), (901, float("nan"), 1e6, None, 1)], df.schema))
    both = ml.score(model, new, ["a", "b"], ["c"], "p").withColumn("q", ml.probability_from(learned, ["a", "b"], ["c"])).collect()
    assert len(both) == 202 and all(abs(r.p - r.q) < 1e-9 for r in both)
    levels = {(i, level) for part, c, i, level, _ in learned if part == "level"}
    assert levels == {(0, "x"), (1, "y"), (2, "missing")}
    assert sum(part == "coefficient" for part, *_ in learned) == 5
    back = ml.parameters(spark, learned)
    assert back.where("part = 'mean' and input = 'b'").head().value == pytest.approx(np.mean([r[2] for r in rows]))

    model = ml.fit_clusters(df, ["a", "b"])
    learned = ml.parameter_rows(model, ["a", "b"], [])
    near = ml.assign_clusters(model, df).withColumn("near", ml.is_nearest(learned, ["a", "b"]))
    assert near.where("not near").count() == 0
    wrong = near.withColumn("cluster", (F.col("cluster") + 1) % ml.CLUSTERS).withColumn("near", ml.is_nearest(learned, ["a", "b"]))
    assert wrong.where("near").count() == 0
