import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marlake.functions import expr


def ts(text):
    return dt.datetime.fromisoformat(text)


def one(spark, column, **values):
    schema = ", ".join(
        f"{k} {'timestamp' if isinstance(v, dt.datetime) else 'date' if isinstance(v, dt.date) else 'string' if isinstance(v, str) or v is None else 'double'}"
        for k, v in values.items()
    )
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).head().x


def test_whole_hours_are_truncated(spark):
    x = expr.whole_hour_days("a", "b")
    assert one(spark, x, a=ts("2024-01-01 00:30:00"), b=ts("2024-01-01 01:29:59")) == 0
    assert one(spark, x, a=ts("2024-01-01 00:00:00"), b=ts("2024-01-02 12:00:00")) == 1.5
    assert one(spark, x, a=ts("2024-01-02 01:30:00"), b=ts("2024-01-02 00:00:00")) == -1 / 24


def test_fractional_days(spark):
    x = expr.fractional_days("a", "b")
    assert one(spark, x, a=ts("2024-01-01 00:00:00"), b=ts("2024-01-01 06:00:00")) == 0.25


def test_sunday_weeks_match_strftime(spark):
    rows = spark.sql(
        "select explode(sequence(date'2015-12-27', date'2022-01-07')) d"
    ).select("d", expr.sunday_week_of_year("d").alias("w"), expr.sunday_week_start("d").alias("s")).collect()
    for r in rows:
        assert r.w == int(r.d.strftime("%U"))
        assert r.s.weekday() == 6 and 0 <= (r.d - r.s).days < 7


@pytest.mark.parametrize("value,padded", [("1", "00001"), ("01234", "01234"), ("123456", "123456"), (None, None)])
def test_zip_pad_never_truncates(spark, value, padded):
    assert one(spark, expr.zip_pad("z"), z=value) == padded


def test_haversine(spark):
    x = expr.haversine_km("a", "b", "c", "d")
    assert one(spark, x, a=0.0, b=0.0, c=0.0, d=180.0) == pytest.approx(math.pi * 6371)
    assert one(spark, x, a=-23.55, b=-46.63, c=-22.91, d=-43.17) == pytest.approx(360.7, abs=1.5)


def test_ratio_is_null_for_zero(spark):
    assert one(spark, expr.ratio("a", "b"), a=1.0, b=0.0) is None


def test_batch_window_id(spark):
    assert one(spark, expr.batch_window_id("t"), t=ts("2024-03-05 23:59:59")) == "live-2024-03-05-18-24"
    assert one(spark, expr.batch_window_id("t"), t=ts("2024-03-05 00:00:00")) == "live-2024-03-05-00-06"


def test_hash_uniform_is_spread_and_stable(spark):
    u = spark.range(20000).select(expr.hash_uniform(F.lit("k"), "id").alias("u"), expr.hash_normal(F.lit("k"), "id").alias("z"))
    r = u.agg(F.avg("u"), F.min("u"), F.max("u"), F.avg("z"), F.stddev("z")).head()
    assert abs(r[0] - 0.5) < 0.01 and r[1] > 0 and r[2] < 1
    assert abs(r[3]) < 0.03 and abs(r[4] - 1) < 0.03
    assert u.head().u == u.head().u
