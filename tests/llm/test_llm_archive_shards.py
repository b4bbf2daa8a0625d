import base64
import hashlib

import brute
import pytest
from pyspark.sql import functions as F

from marlake.llm import sharding, warc

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages():
    rows = [(i, f"http://h{i % 3}/x", f"<p>{i // 4}é</p>") for i in range(40)]
    return rows + [(50, None, None), (51, "u", ""), (None, "n", "<p>0é</p>"), (None, None, None), (7, "http://h1/x", "<p>1é</p>"), (7, "http://h1/x", "<p>1é</p>"), (60, "big", "z" * 300_000), (70, "http://a/", "same page"), (71, "http://b/?q=X-Refers-To-Key: 77\u2028X-Refers-To-Key: 78\r\nX-Refers-To-Key: 79\x85X-Record-Key: 5", "same page")]


@pytest.mark.parametrize("least", [0, 8])
def test_archive_reads_back(spark, tmp_path, pages, least):
    df = spark.createDataFrame(pages, PAGES).withColumns({c: F.lit(1) for c in ("sha256", "copy", "payload", "header", "_bytes")})
    warc.write_archive(df, str(tmp_path / "a"), least_bytes=least)
    got = warc.read_records(spark, str(tmp_path / "a")).collect()
    assert len(got) == len(pages)
    body = {p: (h or "").encode() for p, _, h in pages if p is not None}
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    responses = set()
    for r in got:
        payload = bytes(r["payload"])
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if r["page_id"] is not None:
            assert payload == body[r["page_id"]]
        record = bytes(r["record"])
        head, _, rest = record.partition(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert record.startswith(b"WARC/1.1\r\n") and len(rest) == length + 4
        if r["record_type"] == "revisit":
            assert length == 0 and r["refers_to"] == first[payload.decode()] and len(payload) >= least
        else:
            assert rest[:-4] == payload and r["refers_to"] is None
            if len(payload) >= least:
                assert payload not in responses and r["page_id"] == first[payload.decode()]
                responses.add(payload)
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == len({h or "" for _, _, h in pages})
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    back = warc.read_back(spark, str(tmp_path / "a")).collect()
    assert sorted(repr(tuple(r[n] for n in names)) for r in back) == sorted(repr(tuple(r[n] for n in names)) for r in got)


def test_damaged_payload_is_noticed(spark, tmp_path, pages):
    warc.write_archive(spark.createDataFrame(pages, PAGES), str(tmp_path / "a"))
    headers, payloads = warc.read_archive(spark, str(tmp_path / "a"))
    payloads.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(str(tmp_path / "b/payloads"))
    headers.write.parquet(str(tmp_path / "b/headers"))
    with pytest.raises(Exception, match="does not match its address"):
        warc.read_records(spark, str(tmp_path / "b"), with_payload=False).collect()


def test_empty_archive(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], PAGES), str(tmp_path / "e"))
    assert warc.read_records(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("n", [1, 5, 40])
def test_shards_equal_the_plain_version(awkward, awkward_rows, n):
    got = sharding.assign(awkward, n).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute.shards([(r[0], r[1]) for r in awkward_rows], n)


def test_shards_are_balanced(spark):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(4000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 40)
    sizes = [r["s"] for r in got.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) <= 2 * 416


def test_written_shards_hold_what_was_assigned(spark, tmp_path, awkward, empty):
    assigned = sharding.write_shards(awkward.drop("_t"), str(tmp_path / "s"), 5)
    text = F.coalesce("text", F.lit(""))
    written = spark.read.parquet(str(tmp_path / "s")).select("doc_id", F.crc32(F.encode(text, "UTF-8")).alias("c"), "shard")
    want = [(r["doc_id"], r["text_crc32"], r["shard"]) for r in assigned.collect()]
    assert sorted(map(tuple, written.collect()), key=repr) == sorted(want, key=repr)
    assert sharding.assign(empty).count() == 0
