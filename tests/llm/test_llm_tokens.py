import random
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlake.llm import packing, token_files
from marlake.llm.common import positions, text_slices
from marlake.llm.tokens import WordEncoder

ODD = ["", "  ", "a\x1cb \x1dc", "x\x85y\xa0z", "ΑΣ Σ ΑΣΑ", "İstanbul I", "é ́x café", "<|endoftext|> x<|startoftext|>y", "DON'T i'm 's we'll", "١٢ ½ x²", "日本語 テキスト", " lead trail "]


def test_encoder_equals_the_whole_tokenizer(vocabulary, direct):
    rng = random.Random(3)
    letters = "aAbB'sStT<|>é É ß\xa0\x85\x1c\n\t.,!½²µªİΣςé"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    encoder = WordEncoder(vocabulary)
    for _ in range(2):
        ids, edges = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [direct(t) for t in texts]


def test_slices_hold_every_text_once():
    texts = pa.array(["aa", None, "b" * 50, "", "cc", "d" * 30])
    parts = list(text_slices(texts, 40))
    assert [t for _, p in parts for t in p.to_pylist()] == ["aa", "", "b" * 50, "", "cc", "d" * 30]
    assert [first for first, _ in parts] == sorted({first for first, _ in parts})


def test_positions_count_over_the_whole_table(spark):
    rows = [(None if i % 17 == 0 else i * 7919 % 501, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, w long").repartition(5)
    got = positions(df, [F.col("k").asc_nulls_first()], "w").orderBy("_rank").collect()
    assert [r["_rank"] for r in got] == list(range(3000))
    before = 0
    for a, b in zip(got, got[1:]):
        assert (-1 if a["k"] is None else a["k"]) <= (-1 if b["k"] is None else b["k"])  # null first
        assert a["_before"] == before
        before += a["w"]
    assert {(r["_rows"], r["_total"]) for r in got} == {(3000, sum(w for _, w in rows))}


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 31, 32])
def test_bit_packing_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1000, dtype=np.uint64).astype(np.uint32)
    raw = token_files.pack(ids, width)
    assert len(raw) == (1000 * width + 7) // 8
    assert (token_files.unpack(raw, width, 0, 1000) == ids).all()
    assert (token_files.unpack(raw, width, 333, 701) == ids[333:701]).all()
    assert len(token_files.unpack(raw, width, 5, 5)) == 0
    if width < 32:
        with pytest.raises(ValueError):
            token_files.pack(np.array([1 << width], np.uint32), width)
    assert token_files.width_of(49_408) == 16 and token_files.width_of(65_537) == 17 and token_files.width_of(1) == 1


@pytest.mark.parametrize("size", [49_408, 100_000])
def test_token_files_read_back(spark, tmp_path, awkward, awkward_rows, vocabulary, direct, size):
    path = str(tmp_path / "files")
    token_files.write(awkward, path, vocabulary, size, block_ids=700)
    blocks = token_files.read_blocks(spark, path)
    got = token_files.documents(blocks).collect()
    want = sorted(((-1 if i is None else i), tuple(direct(t) + [2])) for i, t, *_ in awkward_rows)
    assert sorted(((-1 if r["doc_id"] is None else r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start and r["ids_crc32"] == brute.crc(np.frombuffer(r["ids"], "<u4"))
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert blocks.count() > 3
    found = token_files.fetch(blocks, 7)
    assert [f.tolist() for f in found] == [direct(awkward_rows[7][1]) + [2]] * 3
    assert token_files.fetch(blocks, 999) == []


def test_token_files_of_an_empty_table(spark, tmp_path, empty, vocabulary):
    token_files.write(empty, str(tmp_path / "none"), vocabulary, 49_408)
    assert token_files.documents(token_files.read_blocks(spark, str(tmp_path / "none"))).count() == 0


def check_pieces(pieces, texts, size, direct, slack):
    """Every id lies in one piece, sequences are gapless, and little is padded."""
    left = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert p["length"] == len(ids) > 0 and p["ids_crc32"] == brute.crc(ids)
        left[p["doc_id"]].append((p["start"], p["doc_tokens"], tuple(ids)))
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(direct(t) + [2])
    assert set(left) == set(want)
    for i, docs in want.items():
        assert sum(len(d) for d in docs) == sum(len(ids) for _, _, ids in left[i])
        for start, total, ids in left[i]:
            assert any(len(d) == total and tuple(d[start : start + len(ids)]) == ids for d in docs)
        if len(docs) == 1:
            place = 0
            for start, _, ids in sorted(left[i]):
                assert start == place
                place += len(ids)
    windows = defaultdict(list)
    for p in pieces:
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(windows) == list(range(len(windows)))
    padded = 0
    for w in windows.values():
        place = 0
        for offset, n in sorted(w):
            assert offset == place
            place += n
        assert place <= size
        padded += 0 if place & (place - 1) == 0 else size - place
    assert padded <= slack * len(windows)


@pytest.mark.parametrize("most,fan_in,parts", [(2, 2, 7), (4, 64, 3), (1, 2, 1)])
def test_packing_keeps_every_id(awkward, awkward_rows, vocabulary, direct, most, fan_in, parts):
    got = packing.pack(awkward.repartition(parts), vocabulary, size=64, most_open=most, fan_in=fan_in, slack=2).collect()
    check_pieces(got, [(r[0], r[1]) for r in awkward_rows], 64, direct, 2)


def test_packing_of_little_and_nothing(spark, empty, vocabulary, direct):
    assert packing.pack(empty, vocabulary).count() == 0
    one = spark.createDataFrame([(5, "just a few words")], "doc_id long, text string")
    check_pieces(packing.pack(one, vocabulary).collect(), [(5, "just a few words")], 4096, direct, 0)


def test_packer_prefers_the_best_fit():
    p = packing.Packer(10, 2, 0)
    p.add(1, 0, 4, np.arange(4))
    p.add(2, 0, 7, np.arange(7))
    p.add(3, 0, 3, np.arange(3))
    assert [[x[0] for x in w] for w in p.take()] == [[2, 3]]
    p.add(4, 0, 8, np.arange(8))
    p.add(5, 0, 7, np.arange(7))  # fits neither: the fullest (4) is topped up and emitted
    assert [[(x[0], len(x[3])) for x in w] for w in p.take()] == [[(4, 8), (5, 2)]]
    assert len(p.open) <= 2
