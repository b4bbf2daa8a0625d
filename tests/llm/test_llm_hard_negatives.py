import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from marlake.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(rng, n, width, labels):
    """Unit vectors around a few directions, some equal, some scaled, some turned around."""
    centres = rng.normal(size=(5, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(5)] + rng.choice([0.0, 0.05, 0.5, 2.0]) * rng.normal(size=width)
        v = v / np.linalg.norm(v) * rng.choice([0.0, 1.0, 1.0, 1.0, 5.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 1, -1])], int(rng.integers(labels))))
    return rows


def run(spark, rows, every=7, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0, **settings)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("width,labels", [(64, 3), (8, 2), (3, 12)])
def test_equals_the_plain_version(spark, monkeypatch, width, labels):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 40)
    rows = clustered(np.random.default_rng(width), 400, width, labels)
    want = brute.hard_negatives(rows, lambda i: i % 7 == 0)
    assert want and run(spark, rows) == want


def test_other_limits(spark):
    rows = clustered(np.random.default_rng(2), 150, 6, 2)
    settings = {"positives": 2, "negatives": 7, "low_percent": 0, "high_percent": 100, "scale": 10}
    want = brute.hard_negatives(rows, lambda i: i % 7 == 0, 2, 7, 0, 100, 10)
    assert want and run(spark, rows, **settings) == want


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(4)], i % 2) for i in range(40)]
    rows += [(50, None, 1), (51, [1.0, 1.0, 1.0, 1.0], None), (52, [1.0, None, 1.0, 1.0], 1), (53, [nan, 1.0, 1.0, 1.0], 0), (54, [1.0, inf, 1.0, 1.0], 0)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 0.5, 1.0], 1), (55, [], 0), (56, [1.0], 1), rows[7], rows[7], rows[14], (21, [0.5, 0.5, 0.0, 1.0], 0)]
    assert run(spark, rows) == brute.hard_negatives(rows, lambda i: i is not None and i % 7 == 0)
    assert run(spark, rows[:1]) == [] and run(spark, rows[1:6]) == [] and run(spark, [(1, None, None)]) == []
    assert run(spark, [(0, [1e30], 1), (7, [1.0], 1), (8, [0.9], 2)]) == []


def test_a_vector_on_a_third_of_all_rows_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 50)
    rows = clustered(np.random.default_rng(9), 200, 5, 2)
    rows += [(i, [0.1, 0.2, 0.3, 0.4, 0.5], i % 2) for i in range(200, 300)]
    df = spark.createDataFrame(rows, SCHEMA)
    more = {c: F.lit("x") for c in ["row", "id", "v", "anchor", "norm", "angles", "g1", "g2", "kind", "score", "window", "place", "lows", "pieces"]}
    got = hard_negatives.hard_negatives(df.withColumns(more), F.col("vec_id") % 7 == 0).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute.hard_negatives(rows, lambda i: i % 7 == 0)


def test_bounds_never_lose_a_wanted_row():
    rng = np.random.default_rng(4)
    for width in (2, 3, 16):
        vectors = np.floor(256 * rng.normal(size=(600, width)) * rng.choice([0, 0.01, 1, 100], size=(600, 1)))
        vectors[100:200] = vectors[:100] * 3
        norms = np.sqrt((vectors**2).sum(axis=1))
        direction = vectors[7:8] / max(norms[7], 1)
        angles = hard_negatives.angles_to(vectors, norms, direction)[:, 0]
        order = np.argsort(angles[200:]) + 200
        scores = vectors[:200] @ vectors[order].T
        low = np.quantile(scores, rng.random(200), axis=1)[0] if width == 0 else rng.choice(scores.ravel(), 200)
        high = low + np.abs(rng.choice(scores.ravel(), 200)) * rng.random(200)
        first, last = hard_negatives.slices(norms[:200], angles[:200], low, high, norms[order], angles[order])
        place = np.arange(len(order))
        wanted = (scores >= low[:, None]) & (scores <= high[:, None])
        assert not (wanted & ((place < first[:, None]) | (place >= last[:, None]))).any()
