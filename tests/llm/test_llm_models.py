import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import prose
from pyspark.sql import functions as F

from marlake.llm import importance, toxicity
from marlake.llm.common import without

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def plain_grams(text):
    cut = importance.pc.replace_substring_regex(pa.array([text]), importance.MARKS, r" \1 ")[0].as_py().split()
    return cut, list(zip(cut, cut[1:]))


def test_grams_do_not_cross_texts():
    owner, bucket = importance.grams(pa.array(["a b!! c", "", "  ", "c a", "a b!! c"]))
    assert np.bincount(owner, minlength=5).tolist() == [7, 0, 0, 3, 7]
    assert sorted(bucket[owner == 0]) == sorted(bucket[owner == 4])
    assert len(plain_grams("a b!! c")[0]) + len(plain_grams("a b!! c")[1]) == 7


def test_models_count_all_documents(spark, awkward, awkward_rows):
    rows = awkward.select(F.coalesce("text", F.lit("")).alias("_text"), (F.col("doc_id") % 2).cast("int").alias("_good"), F.lit(True).alias("_fit"))
    importance.with_package(spark)
    raw, target = importance.count_models(rows, 512)
    texts = pa.array([r[1] or "" for r in awkward_rows])
    owner, bucket = importance.grams(texts, 512)
    good = np.array([r[0] is not None and r[0] % 2 == 1 for r in awkward_rows])
    assert raw.tolist() == np.bincount(bucket, minlength=512).tolist()
    assert target.tolist() == np.bincount(bucket[good[owner]], minlength=512).tolist()


def test_resampling_keeps_good_and_rejects_bad(real):
    docs, labels = real
    out = importance.resample(docs, labels).join(labels, "doc_id").toPandas()
    assert out[out.quality == 1].kept.mean() > 0.98
    assert out[out.quality == 0].kept.mean() < 0.05


def test_top_k_takes_exactly_k(real):
    docs, labels = real
    out = importance.resample(docs, labels, keep=300).toPandas()
    assert out.kept.sum() == 300 and len(out) == docs.count()
    assert out[out.kept].noisy.min() >= out[~out.kept].noisy.max()
    again = importance.resample(docs.repartition(5), labels, keep=300).toPandas()
    assert set(again[again.kept].doc_id) == set(out[out.kept].doc_id)
    noise = out.noisy - out.weight
    assert abs(noise.mean() - 0.5772) < 0.2  # the mean of the Gumbel distribution


def test_a_share_is_drawn_above_the_floor(real):
    docs, labels = real
    out = importance.resample(docs, labels, keep=0.5).toPandas()
    assert out.kept.sum() == math.ceil(out.above_floor.sum() / 2) and out[out.kept].above_floor.all()
    rest = out[out.above_floor & ~out.kept]
    assert out[out.kept].noisy.min() >= rest.noisy.max()


def test_weights_equal_plain_counts(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 5 + i % 40, 30) + (" !! ok" if i % 3 else " zz %")) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 90, 2)], "doc_id long, quality int")
    raw, target = Counter(), Counter()
    fit = {r["_id"] for r in importance.target_ids(labels, "doc_id", "quality", 1000).collect() if r["_fit"] and r["_good"]}
    for i, text in rows:
        for part in plain_grams(text):
            raw.update(part)
            target.update(part if i in fit else [])
    share, pseudo = sum(target.values()) / sum(raw.values()), importance.PSEUDO
    ratio = {g: math.log((target[g] + pseudo) / (share * n + pseudo)) for g, n in raw.items()}
    want = {i: sum(ratio[g] for part in plain_grams(text) for g in part) for i, text in rows}
    got = importance.resample(docs, labels, buckets=1 << 22).collect()
    assert len(got) == 90 and all(abs(r["weight"] - want[r["doc_id"]]) < 1e-4 for r in got)


def test_inclusion_follows_the_ratio_of_the_models(spark):
    texts = ["good words here", "good words other", "plain stuff here", "bad bad junk", "bad junk"]
    docs = spark.createDataFrame([(i, texts[i % 5]) for i in range(10_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 < 2)) for i in range(400)], "doc_id long, quality int")
    for seed, temperature in ((1, 1.0), (2, 1.0), (3, 4.0)):
        out = importance.resample(docs, labels, keep=3000, floor=False, seed=seed, temperature=temperature).toPandas()
        assert out.kept.sum() == 3000
        rate = np.exp(out.weight / temperature)  # kept if an exponential time of this rate comes before a common one
        low, high = -60.0, 60.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if (1 - np.exp(-rate * np.exp(middle))).sum() < 3000 else (low, middle)
        out["expected"] = 1 - np.exp(-rate * np.exp(low))
        seen = out.groupby(out.doc_id % 5)[["kept", "expected"]].mean()
        assert (seen.kept - seen.expected).abs().max() < 0.04
        assert ((seen.expected > 0.05) & (seen.expected < 0.95)).sum() >= 2  # the draw decides, not the rank


def test_resampling_of_awkward_tables(spark, awkward, awkward_rows, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    out = importance.resample(awkward, labels).collect()
    assert len(out) == len(awkward_rows)
    assert all(r["weight"] == 0 and r["n_grams"] == 0 for r in out if r["doc_id"] in (100, 101, 102))
    assert all(r["kept"] for r in importance.resample(awkward, labels.limit(0)).collect())
    assert importance.resample(empty, labels).count() == 0


def test_without_matches_nulls(spark, awkward, awkward_rows):
    verdicts = awkward.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.col("text").isNull().alias("gone"))
    left = without(awkward, verdicts, F.col("gone"))
    assert left.count() == sum(r[1] is not None for r in awkward_rows)


def test_cut_between_labels():
    assert importance.cut_of(np.array([]), np.array([1.0])) == -np.inf
    assert 1 < importance.cut_of(np.array([2.0, 3.0, 4.0]), np.array([0.0, 1.0])) < 2


def test_char_grams_by_hand():
    found = [sorted(zip(o.tolist(), b.tolist())) for o, b in toxicity.gram_places(pa.array(["Ab", "", "ab\n ab"]), orders=(3,))]
    owners = [o for o, _ in found[0]]
    assert owners == [0, 0, 2, 2, 2, 2, 2]  # " ab ", "  " (too short), " ab ab "
    buckets = [b for o, b in found[0] if o == 0]
    assert set(buckets) <= {b for o, b in found[0] if o == 2}


def test_held_out_accuracy(real):
    docs, labels = real
    out = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").toPandas()
    test = out[out.held_out]
    rank, bad = test.score.rank(), test.toxic == 1
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.9
    assert test[~bad].predicted.mean() < 0.05
    assert out.score.between(0, 1).all()


def test_held_out_labels_are_never_used(real):
    docs, labels = real
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert a.buckets.tolist() == b.buckets.tolist() and np.allclose(a.weights, b.weights, atol=1e-6)


def test_scores_of_awkward_tables(spark, awkward, awkward_rows, empty):
    rng = random.Random(1)
    bad = [(200 + i, prose(rng, 30) + " nastyword", 1) for i in range(30)]
    good = [(300 + i, prose(rng, 30), 0) for i in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in bad + good], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in bad + good] + [(None, 1), (7, None), (8, 5)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    high, low = [r["score"] for r in got if r["doc_id"] < 300], [r["score"] for r in got if r["doc_id"] >= 300]
    assert sum(a > b for a in high for b in low) >= 0.98 * len(high) * len(low)
    out = toxicity.score(awkward, model).collect()
    assert len(out) == len(awkward_rows) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (100, 101)}) == 1
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(docs, labels.limit(0)).intercept == 0.0
    assert toxicity.fit(empty, labels).intercept == 0.0
