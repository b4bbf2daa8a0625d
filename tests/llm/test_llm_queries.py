"""The registered queries and the pipeline over a small folder."""

import brute
import compare
import pytest

import corpus_pipeline
from marlake.llm.queries import QUERIES, REFERENCE_SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    problem, rows, _ = compare.check(spark, compare.connect(FOLDER), name, QUERIES, REFERENCE_SQL, FOLDER)
    assert problem is None and rows > 0, problem


def test_one_query_of_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_packed_ids_equal_the_plain_version(spark, texts, direct):
    want, start = [], 0
    for i, t in sorted(texts):
        ids = direct(t) + [2]
        want.append((i, start, len(ids), brute.crc(ids)))
        start += len(ids)
    got = QUERIES["op6_bit_packed_ids"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_packing_covers_every_id_with_little_padding(spark, texts, direct):
    ids = {i: direct(t) + [2] for i, t in texts}
    place, windows = {}, {}
    rows = QUERIES["op2_online_packing"](spark, FOLDER).collect()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == place.get(r["doc_id"], 0) and r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == brute.crc(own[r["start"] : r["start"] + r["length"]])
        place[r["doc_id"]] = r["start"] + r["length"]
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert place == {i: len(own) for i, own in ids.items()}
    lengths = []
    for w in windows.values():
        end = 0
        for offset, n in sorted(w):
            assert offset == end
            end += n
        lengths.append(end)
    padded = sum(0 if n & (n - 1) == 0 else 4096 - n for n in lengths)
    assert max(lengths) <= 4096 and padded <= 0.002 * sum(lengths) and sorted(windows) == list(range(len(windows)))


def test_shards_equal_the_plain_version(spark, texts):
    got = QUERIES["op8_prefix_sum_shards"](spark, FOLDER).select("doc_id", "size", "text_crc32", "law", "shard", "slot").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute.shards(texts, 40)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near duplicates", "benchmark decontamination", "personal data", "packing"]
    tables = [docs]
    for _, step in corpus_pipeline.STAGES:
        tables.append(corpus_pipeline.stage(step(spark, tables[-1], FOLDER)))
    for t in tables[1:-1]:
        assert t.columns == docs.columns
    ids = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in tables]
    assert ids[1] <= ids[0] and ids[3] <= ids[2] and ids[4] == ids[3] and ids[5] == ids[4]
    groups = brute.near([(r["doc_id"], r["text"]) for r in tables[1].collect()], corpus_pipeline.PERCENT)
    assert ids[2] == {i for i, (_, c) in groups.items() if c == i}
    assert corpus_pipeline.run(spark, FOLDER).count() == tables[5].count()


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark, awkward):
    out = corpus_pipeline.near_duplicates(spark, awkward, FOLDER).collect()
    assert len([r for r in out if r["doc_id"] == 7]) == 1


def test_near_duplicate_stage_judges_rows_without_an_id_and_texts_that_share_one(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(None, a), (None, a), (None, b), (1, b), (2, c), (2, d), (3, c), (4, d), (1, d)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()]
    assert sorted(out, key=repr) == sorted([(None, a), (1, b), (2, c), (1, d)], key=repr)
