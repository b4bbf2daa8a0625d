import hashlib
import random
import time

import brute
import pytest

from marlake.llm import periodic_runs
from marlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def as_bytes(w):
    return [str(x).encode() for x in w]


def random_words(rng):
    """Words of a small alphabet, with powers, nested powers and near powers put together."""
    out = []
    while len(out) < rng.randrange(10, 160):
        kind = rng.randrange(4)
        if kind == 0:
            out += [rng.randrange(50) for _ in range(rng.randrange(12))]
        elif kind == 1:
            out += [rng.randrange(2) for _ in range(rng.randrange(20))]
        else:
            unit = [rng.randrange(3 if kind == 2 else 90) for _ in range(rng.randrange(1, 12))]
            power = unit * rng.randrange(1, 9)
            out += power[: len(power) - rng.randrange(len(unit))]
            if rng.random() < 0.3:
                out += out[-rng.randrange(1, 40) :] * 2
    return out


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_the_plain_version(least):
    rng = random.Random(least)
    found = 0
    for _ in range(400):
        w = as_bytes(random_words(rng))
        want = brute.runs(w, least)
        assert periodic_runs.runs_of(w, least) == want, w
        assert periodic_runs.collapsed(w, want).decode() == brute.collapsed([x.decode() for x in w], want)
        found += len(want)
    assert found > 500


def test_borders_and_smallest_period():
    w = as_bytes(["x", *["a", "b", "c"] * 4, "a", "y", *["z"] * 12, *["k"] * 11])
    assert periodic_runs.runs_of(w, 12) == [(1, 13, 3), (15, 12, 1)]
    assert periodic_runs.collapsed(w, [(1, 13, 3), (15, 12, 1)]) == b" ".join([b"x", b"a", b"b", b"c", b"y", b"z", *[b"k"] * 11])


def test_long_texts_take_little_time():
    rng = random.Random(1)
    unit = [rng.randrange(5000) for _ in range(9000)]
    start = time.process_time()
    assert periodic_runs.runs_of(as_bytes([7] * 100_000), 12) == [(0, 100_000, 1)]
    assert (40, 27_000, 9000) in periodic_runs.runs_of(as_bytes([9999] * 40 + unit * 3), 12)
    nested = [0]
    for k in range(1, 15):
        nested = [*nested, k, *nested]
    periodic_runs.runs_of(as_bytes(nested), 12)
    assert time.process_time() - start < 20


def test_awkward_rows(awkward, awkward_rows, empty):
    got = periodic_runs.periodic_runs(awkward, min_words=5).collect()
    want = []
    for r in awkward_rows:
        w = brute.words(r[1])
        found = brute.runs(w, 5) if len(w) < 5000 else []
        want.append((r[0], len(w), found, brute.collapsed(w, found)))
    assert sorted([(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got], key=repr) == sorted(want, key=repr)
    assert periodic_runs.periodic_runs(empty).count() == 0
    assert periodic_runs.planted(empty).count() == 0


def test_planting_equals_the_plain_version(spark, awkward_rows, awkward):
    got = periodic_runs.planted(awkward).collect()
    assert sorted((repr(r["doc_id"]), repr(brute.words(r["text"]))) for r in got) == sorted((repr(r[0]), repr(brute.planted(r[0], r[1]))) for r in awkward_rows)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_the_query_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want, with_runs = {}, 0
    for d in docs:
        w = brute.planted(d["doc_id"], d["text"])
        if len(w) > 2500:
            continue
        found = brute.runs(w)
        with_runs += bool(found)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want[d["doc_id"]] = (len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(brute.collapsed(w, found)))
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = QUERIES["op12_periodic_runs"](spark, FOLDER).collect()
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in rows}
    assert len(rows) == len(docs) and with_runs > 10 and len(want) > 150
    assert {i: got[i] for i in want} == want
