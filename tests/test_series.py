import datetime as dt

import numpy as np
import pandas as pd
import pytest

from marlake.plans import ml, series

START = dt.date(2022, 1, 1)


@pytest.fixture(scope="module")
def daily(spark):
    rng = np.random.default_rng(4)
    rows = []
    for key, first, days, slope in (("a", 0, 800, 0.5), ("b", 300, 500, -0.2), (None, 100, 700, 0.0)):
        for i in range(days):
            if key == "b" and i % 5 == 3 and i < days - 1:
                continue  # a day without sale
            rows.append((key, START + dt.timedelta(first + i), 200 + slope * i + 30 * ((first + i) % 7 < 2) + float(rng.normal(0, 5))))
    return spark.createDataFrame(rows, "key string, ds date, y double")


def test_days_without_rows_count_zero(daily):
    out = series.filled(daily.union(daily.where("key = 'a' and ds = '2022-01-05'"))).toPandas()
    assert out.groupby(out.key.fillna("none")).size().to_dict() == {"a": 800, "b": 500, "none": 700}
    assert (out[out.key == "b"].y == 0).sum() == 100
    once = daily.where("key = 'a' and ds = '2022-01-05'").head().y
    assert out[(out.key == "a") & (out.ds == dt.date(2022, 1, 5))].y.item() == pytest.approx(2 * once)


@pytest.mark.parametrize("ridge", [0.0, 0.01])
def test_coefficients_equal_least_squares(spark, daily, ridge):
    holidays = ml.holiday_days(ml.holiday_calendar(spark, [2022, 2023, 2024]))
    rows, inputs = series.inputs_of(series.filled(daily), holidays, 2, 3, True)
    got = {r.key: r for r in series.fit(rows, inputs, ridge).collect()}
    table = rows.toPandas()
    assert set(got) == {"a", "b", None} and len(inputs) == 1 + 4 + 6 + len(ml.HOLIDAYS)
    for key, r in got.items():
        own = table[table.key.isna() if key is None else table.key == key]
        x, y = own[inputs].to_numpy(float), own.y.to_numpy()
        centred, n = x - x.mean(0), len(y)
        shrink = np.diag([0.0 if c == "t" else np.sqrt(ridge * n * v) for c, v in zip(inputs, centred.var(0))])
        want = np.linalg.lstsq(np.vstack([centred, shrink]), np.concatenate([y - y.mean(), np.zeros(len(inputs))]), rcond=1e-8)[0]
        seen = centred @ np.array(r.coefficients)
        assert np.allclose(seen, centred @ want, atol=1e-5) and r.days == n
        assert r.intercept == pytest.approx(y.mean() - x.mean(0) @ np.array(r.coefficients), abs=1e-6)
        assert r.rmse == pytest.approx(np.sqrt(np.mean((y - y.mean() - seen) ** 2)), abs=1e-5)


def test_forecasts_follow_every_series(daily):
    out = series.forecast_many(daily, yearly=0).toPandas()
    assert out.groupby(out.key.fillna("none")).size().to_dict() == {"a": 90, "b": 90, "none": 90}
    assert ((0 <= out.yhat_lower) & (out.yhat_lower <= out.yhat) & (out.yhat <= out.yhat_upper)).all()
    a = out[out.key == "a"].sort_values("ds")
    want = [200 + 0.5 * i + 30 * (i % 7 < 2) for i in range(800, 890)]
    assert np.abs(a.yhat.to_numpy() - want).mean() < 3


def test_no_rows_and_short_series(spark, daily):
    assert series.forecast_many(daily.limit(0)).count() == 0
    assert series.forecast_many(daily.select("key", "y").withColumn("ds", ml.F.lit(None).cast("date"))).count() == 0
    one = spark.createDataFrame([("x", START, 5.0), ("y", START - dt.timedelta(1), None)], "key string, ds date, y double")
    out = series.forecast_many(one, horizon=3).orderBy("key", "ds").toPandas()
    assert len(out) == 6 and out[out.key == "x"].yhat.tolist() == pytest.approx([5.0] * 3)
    assert not pd.isna(out.yhat).any()
