import random

import brute
import pytest

from marlake.llm import near_dup

SCHEMA = "doc_id long, text string"


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def groups():
    """Near copies at many distances, exact copies, shared passages, short texts."""
    rng = random.Random(11)
    rows = []
    passage = [f"p{k}" for k in range(30)]
    for g in range(6):
        base = [f"g{g}w{rng.randrange(3000)}" for _ in range(rng.choice([30, 90, 150, 400]))]
        for _ in range(14):
            rows.append(edited(rng, base, rng.randrange(0, max(2, len(base) // 25))))
        rows.append(" ".join(base).upper())
    hub = [f"h{k}" for k in range(120)]
    rows += [" ".join(hub)] * 5 + [edited(rng, hub, rng.randrange(0, 9)) for _ in range(90)]
    rows += [" ".join(passage + [f"x{i}y{k}" for k in range(rng.randrange(1, 40))]) for i in range(40)]
    rows += ["a b", "A b", "a b c d e", "a b c d e f", "", " ", None, "É a b c d e", "é a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("most_in_list", [1, 8, 64])
@pytest.mark.parametrize("percent", [80, 85])
def test_equals_all_pairs(spark, groups, most_in_list, percent):
    want = brute.near(groups, percent)
    got = near_dup.near_duplicates(spark.createDataFrame(groups, SCHEMA).repartition(4), percent=percent, most_in_list=most_in_list).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_awkward_rows(awkward, awkward_rows):
    got = near_dup.near_duplicates(awkward).collect()
    assert len(got) == len(awkward_rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    want = brute.near([(i, t) for i, t, *_ in awkward_rows if i is not None])
    assert {i: {(n, c, c == i)} for i, (n, c) in want.items()} == {i: v for i, v in by_id.items() if i is not None}
    assert {c for _, c, _ in by_id[None]} == {None, 4}  # the copy of document 4, and the row without a text


def test_empty_table(empty):
    assert near_dup.near_duplicates(empty).count() == 0


def test_components_follow_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in near_dup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
