"""Token ids in fixed-width bit-packed blocks, with offsets for vectorised and random access.

A file row is one block of whole documents: ``part`` and ``block`` (its place), ``before`` (ids of
the part before it), ``n_ids``, ``width`` (bits per id), ``first_doc`` / ``last_doc`` (smallest and
largest id, null if all are null), ``doc_ids``, ``offsets`` (where each document's ids begin in
the block, one more than documents) and ``payload``: id i stands in bits i * width to
(i + 1) * width - 1, least significant bit first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlake.llm.common import frugal, small_side, text_slices, with_package
from marlake.llm.tokens import encoder
from marlake.session import stage

END_ID = 2
BLOCK_IDS = 1 << 18
BLOCKS = "part int, block int, before long, n_ids long, width int, first_doc long, last_doc long, doc_ids array<long>, offsets array<long>, payload binary"


def width_of(vocabulary: int) -> int:
    """Fewest bits that hold every id of a vocabulary of this size."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as one little-endian bit string of ``width`` bits each."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} does not fit into {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8), axis=None, bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` - 1 of a packed block, reading only the bytes that hold them."""
    if width in (8, 16, 32):
        return np.frombuffer(payload, f"<u{width // 8}", stop - start, start * width // 8).astype(np.uint32)
    first, skip = divmod(start * width, 8)
    held = np.frombuffer(payload, np.uint8, (stop * width + 7) // 8 - first, first)
    bits = np.unpackbits(held, bitorder="little")[skip : skip + (stop - start) * width]
    return (bits.reshape(-1, width).astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def write(docs: DataFrame, path: str, vocabulary: str, size: int, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the packed blocks in ascending id order to ``path``.

    Rows are range-partitioned by id (null first) and, for equal ids, a hash of the text; a part's
    blocks follow each other in that order. A block takes whole documents until it has
    ``block_ids`` ids, so a longer document makes a block of its own. ``size`` is the number of
    ids in the vocabulary. Null text gives the end id alone, repeated rows are written each, an
    empty table gives no block, and other columns are ignored.
    """
    width = width_of(size)

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, before
            ids = np.concatenate(held)
            known = [n for n in names if n is not None]
            row = [part, block, before, len(ids), width, min(known, default=None), max(known, default=None), list(names), [0, *np.cumsum(lengths).tolist()], pack(ids, width)]
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, TYPES)], names=FIELDS)
            block, before = block + 1, before + len(ids)
            held.clear(), names.clear(), lengths.clear()
            return out

        found, waiting = encoder(vocabulary), 0
        for batch in batches:
            own = batch.column(0).to_pylist()
            for first, texts in text_slices(batch.column(1)):
                ids, edges = found.encode(texts)
                for i in range(len(texts)):
                    mine = np.append(ids[edges[i] : edges[i + 1]], np.uint32(end_id))
                    held.append(mine)
                    names.append(own[first + i])
                    lengths.append(len(mine))
                    waiting += len(mine)
                    if waiting >= block_ids:
                        yield flush()
                        waiting = 0
        if names:
            yield flush()

    with_package(docs.sparkSession)
    order = [F.col("_id").asc_nulls_first(), F.xxhash64("_text")]
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(frugal(blocks), BLOCKS).write.mode("overwrite").parquet(path)


FIELDS = [f.split()[0] for f in BLOCKS.split(", ")]
TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def documents(blocks: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of the given blocks: ``doc_id``, ``start`` (all ids before it), ``n_tokens``, ``ids_crc32`` and ``ids``.

    ``start`` counts over the whole file set, so pass all blocks; one total per part is brought
    together for it. ``ids`` are unsigned 32-bit integers, little-endian, as one binary value; the
    checksum is theirs. Without ``with_ids`` only the checksum leaves the task.
    """
    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["width"], 0, row["n_ids"]).astype("<u4")
                edges = np.asarray(row["offsets"])
                raw = [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                out = [
                    pa.array([row["part"]] * len(raw), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["before"] + edges[:-1], pa.int64()),
                    pa.array(np.diff(edges), pa.int64()),
                    pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                ] + [pa.array(raw, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in schema.split(", ")])

    with_package(blocks.sparkSession)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    base = stage(totals.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")), "parts")
    found = blocks.mapInArrow(frugal(rows), schema).join(small_side(base), "part")
    return found.withColumn("start", F.col("start") + F.col("_base")).drop("part", "_base")


def fetch(blocks: DataFrame, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row with that id): only blocks that can hold it are read, and only its bits unpacked."""
    found = []
    for row in blocks.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).orderBy("part", "block").toLocalIterator():
        for i, name in enumerate(row["doc_ids"]):
            if name == doc_id:
                found.append(unpack(bytes(row["payload"]), row["width"], row["offsets"][i], row["offsets"][i + 1]))
    return found
