"""Running values, priors, moving means and quantiles against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlake.operators import ewma, ordered, priors
from marlake.operators.ewma import prior_ewma
from marlake.operators.ordered import running
from marlake.operators.quantiles import exact_quantiles


def frame(n=3000, hot=0.4, nulls=0.1, seed=7):
    """Groups of which one holds 40% of the rows; times repeat a lot, ids do not."""
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < hot, "hot", np.array([f"g{i}" for i in rng.integers(0, 40, n)]))
    g = np.where(rng.random(n) < 0.05, None, g)
    x = np.where(rng.random(n) < nulls, np.nan, rng.integers(0, 2, n).astype(float))
    return pd.DataFrame({"g": g, "t": rng.integers(0, 50, n), "k": [f"k{i:06d}" for i in rng.permutation(n)], "x": x})


def to_spark(spark, pdf):
    rows = [
        tuple(None if (isinstance(v, float) and np.isnan(v)) or v is None else (v if isinstance(v, str) else float(v)) for v in r)
        for r in pdf.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, "g string, t double, k string, x double")


def by_key(df, *cols):
    return df.select("k", *cols).toPandas().set_index("k").sort_index()


@pytest.mark.parametrize("groups", [["g"], []])
def test_running_matches_a_plain_window(spark, many_chunks, groups):
    pdf = frame()
    out = by_key(
        running(
            to_spark(spark, pdf), groups, ["t", "k"],
            sums={"pos": F.lit(1), "s": F.coalesce("x", F.lit(0.0))}, last={"seen": "x"}, totals={"rows": "pos"},
        ),
        "pos", "s", "seen", "rows",
    )
    sorted_ = pdf.sort_values(["t", "k"]).copy()
    key = sorted_["g"].fillna("~") if groups else pd.Series("all", index=sorted_.index)
    sorted_["pos"] = sorted_.groupby(key).cumcount()
    filled = sorted_["x"].fillna(0)
    sorted_["s"] = filled.groupby(key).cumsum() - filled
    sorted_["seen"] = sorted_.groupby(key)["x"].transform(lambda v: v.ffill().shift(1))
    sorted_["rows"] = sorted_.groupby(key)["k"].transform("count")
    want = sorted_.set_index("k").sort_index()
    assert (out.pos == want.pos).all() and (out.rows == want["rows"]).all()
    np.testing.assert_allclose(out.s, want.s)
    np.testing.assert_array_equal(out.seen.to_numpy(float), want.seen.to_numpy(float))


def test_a_hot_group_is_spread_over_chunks(spark, many_chunks):
    df = spark.range(20000).select(F.lit("hot").alias("g"), F.lit(1.0).alias("t"), F.col("id").cast("string").alias("k"))
    df = df.unionByName(df.limit(50).withColumn("g", F.lit("small")))
    cut = ordered.with_chunks(df, ordered.chunk_bounds(df, ["g"], ["t", "k"]), ["g"], ["t", "k"])
    sizes = [r["count"] for r in cut.where("g = 'hot'").groupBy("_chunk").count().collect()]
    assert len(sizes) >= 100 and max(sizes) < 1500 and sum(sizes) == 20000
    assert cut.where("g = 'small' and _chunk > 0").isEmpty()
    spans = cut.where("g = 'hot'").groupBy("_chunk").agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("_chunk").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))
    out = running(df, ["g"], ["t", "k"], sums={"pos": F.lit(1)})
    assert out.where("g = 'hot'").agg(F.sum("pos")).head()[0] == sum(range(20000))


def test_nothing_is_written_for_groups_of_common_size(spark, monkeypatch):
    written = []
    monkeypatch.setattr(ordered, "stage", lambda df, name: written.append(name))
    out = running(to_spark(spark, frame()), ["g"], ["t", "k"], sums={"pos": F.lit(1)}, then_last={"seen": F.when(F.col("x") > 0, F.col("pos"))})
    text = out._jdf.queryExecution().executedPlan().toString()
    assert not written and text.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in text


def test_priors_match_pandas(spark, many_chunks):
    pdf = frame(nulls=0.0)
    df = priors.global_prior(to_spark(spark, pdf), ["t", "k"], "x", "glob")
    df = priors.expanding_prior(df, "g", ["t", "k"], "x", "rate", "glob")
    df = priors.shrunken_prior(df, "g", ["t", "k"], "x", "shrunk", "glob", 15)
    out = by_key(df, "glob", "rate", "shrunk")
    p = pdf.sort_values(["t", "k"]).copy()
    p["glob"] = p["x"].shift(1).expanding().mean().fillna(p["x"].mean())
    grouped = p.groupby("g")["x"]
    mean = grouped.transform(lambda s: s.shift(1).expanding().mean())
    count = grouped.transform(lambda s: s.shift(1).expanding().count()).fillna(0)
    p["rate"] = mean.fillna(p["glob"])
    p["shrunk"] = (mean.fillna(p["glob"]) * count + p["glob"] * 15) / (count + 15)
    p = p.set_index("k").sort_index()
    for c in ("glob", "rate", "shrunk"):
        np.testing.assert_allclose(out[c], p[c], atol=1e-12)


def test_prior_does_not_see_later_rows(spark):
    pdf = frame(400, nulls=0.0)
    early = pdf[pdf.t < 25]

    def rate(p):
        df = priors.prior_mean(to_spark(spark, p), ["g"], ["t", "k"], {"rate": "x"}, count="n")
        return by_key(df, "rate", "n")

    whole = rate(pdf).loc[sorted(early.k)]
    pd.testing.assert_frame_equal(whole, rate(early))


@pytest.mark.parametrize("nulls", [0.0, 0.3, 0.97])
def test_ewma_matches_pandas(spark, many_chunks, nulls):
    pdf = frame(4000, nulls=nulls)
    pdf = pdf[pdf.g.notna()].copy()
    pdf["x"] = pdf["x"] * np.arange(len(pdf)) % 17
    out = by_key(prior_ewma(to_spark(spark, pdf), ["g"], ["t", "k"], "x", "e"), "e")
    p = pdf.sort_values(["g", "t", "k"])
    p["e"] = p.groupby("g")["x"].transform(lambda s: s.shift(1).ewm(alpha=0.3, adjust=False).mean())
    p = p.set_index("k").sort_index()
    np.testing.assert_allclose(out.e.to_numpy(float), p.e.to_numpy(float), atol=1e-9)


def test_ewma_through_the_current_row(spark):
    pdf = frame(300, nulls=0.2)
    pdf = pdf[pdf.g.notna()]
    out = by_key(prior_ewma(to_spark(spark, pdf), ["g"], ["t", "k"], "x", "e", through="now"), "now")
    p = pdf.sort_values(["g", "t", "k"])
    p["now"] = p.groupby("g")["x"].transform(lambda s: s.ewm(alpha=0.3, adjust=False).mean())
    np.testing.assert_allclose(out.now.to_numpy(float), p.set_index("k").sort_index().now.to_numpy(float), atol=1e-9)


def test_ewma_over_a_long_gap(spark):
    n = 1500
    x = [None] * n
    x[0], x[3], x[1200], x[1201] = 5.0, 1.0, 9.0, 4.0
    df = spark.createDataFrame([("a", float(i), f"{i:05d}", x[i]) for i in range(n)], "g string, t double, k string, x double")
    out = by_key(prior_ewma(df, ["g"], ["t", "k"], "x", "e"), "e")
    want = pd.Series(x, dtype=float).shift(1).ewm(alpha=0.3, adjust=False).mean()
    np.testing.assert_allclose(out.e.to_numpy(float), want.to_numpy(), atol=1e-12)


@pytest.mark.parametrize("alpha", [0.01, 0.3, 0.95])
def test_ewma_of_any_weight_over_many_blocks(spark, many_chunks, monkeypatch, alpha):
    """Small blocks and runs, so that the steps are combined over several levels."""
    monkeypatch.setattr(ewma, "BLOCK", 7)
    monkeypatch.setattr(ewma.block_starts, "__defaults__", (3,))
    pdf = frame(3000, nulls=0.2)
    out = by_key(prior_ewma(to_spark(spark, pdf), ["g"], ["t", "k"], "x", "e", alpha, through="now"), "e", "now")
    p = pdf.sort_values(["g", "t", "k"], na_position="first")
    p["e"] = p.groupby("g", dropna=False)["x"].transform(lambda s: s.shift(1).ewm(alpha=alpha, adjust=False).mean())
    p["now"] = p.groupby("g", dropna=False)["x"].transform(lambda s: s.ewm(alpha=alpha, adjust=False).mean())
    p = p.set_index("k").sort_index()
    np.testing.assert_allclose(out.e.to_numpy(float), p.e.to_numpy(float), atol=1e-9)
    np.testing.assert_allclose(out.now.to_numpy(float), p.now.to_numpy(float), atol=1e-9)


def test_ewma_weight_is_checked():
    for alpha in (0.0, 1.0):
        with pytest.raises(ValueError):
            ewma.block_length(alpha)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101])
def test_quantiles_match_pandas(spark, many_chunks, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], n), "x": rng.integers(0, 20, n) / 4})
    df = spark.createDataFrame([(r.g, float(r.x)) for r in pdf.itertuples()] + [("a", None)], "g string, x double")
    probs = {"p0": 0.0, "p25": 0.25, "p33": 0.33, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    whole = exact_quantiles(df, "x", probs).head()
    grouped = {r.g: r for r in exact_quantiles(df, "x", probs, ["g"]).collect()}
    for name, p in probs.items():
        assert whole[name] == pytest.approx(pdf.x.quantile(p))
        for g, part in pdf.groupby("g"):
            assert grouped[g][name] == pytest.approx(part.x.quantile(p))
