"""Bounded-space online packing of token ids into windows of a fixed length.

Each task keeps a fixed number of open windows. A document fills whole windows first; what is left
of it goes into the open window that it fits best. If it fits none and no window may be opened, the
fullest one is emitted: topped up with the head of the piece unless it lacks only a few ids. What
is open at the end of a task is merged: the open windows of many tasks are packed again, level by
level, until one group is left, whose rest is cut into lengths that are powers of two and so
need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlake.llm.common import frugal, small_side, text_slices, with_package
from marlake.llm.tokens import encoder
from marlake.session import stage

WINDOW = 4096
OPEN = 32
FAN_IN = 64
SLACK = 8
END_ID = 2

PIECES = "part int, seq long, closed boolean, doc_id long, start long, length long, doc_tokens long, offset long, ids_crc32 long, ids binary"
FIELDS = [f.split()[0] for f in PIECES.split(", ")]
TYPES = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


class Packer:
    """At most ``most`` open windows of ``size`` ids; pieces are (doc_id, start, doc_tokens, ids)."""

    def __init__(self, size: int = WINDOW, most: int = OPEN, slack: int = SLACK):
        self.size, self.most, self.slack = size, most, slack
        self.open: list[list] = []  # [free, pieces]
        self.done: list[list] = []

    def add(self, doc_id, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids) >= self.size:
            self.done.append([(doc_id, start, total, ids[: self.size])])
            start, ids = start + self.size, ids[self.size :]
        if not len(ids):
            return
        best = min((w for w in self.open if w[0] >= len(ids)), key=lambda w: w[0], default=None)
        if best is None and len(self.open) >= self.most:
            fullest = min(self.open, key=lambda w: w[0])
            if fullest[0] > self.slack:
                cut = fullest[0]
                fullest[1].append((doc_id, start, total, ids[:cut]))
                start, ids = start + cut, ids[cut:]
            self.open.remove(fullest)
            self.done.append(fullest[1])
        if best is None:
            self.open.append([self.size - len(ids), [(doc_id, start, total, ids)]])
            return
        best[0] -= len(ids)
        best[1].append((doc_id, start, total, ids))
        if not best[0]:
            self.open.remove(best)
            self.done.append(best[1])

    def finish(self) -> None:
        """Close what is open, in windows that are full or as long as a power of two."""
        rest = [p for w in self.open for p in w[1]]
        self.open = []
        left = sum(len(p[3]) for p in rest)
        window: list = []
        room = goal = self.goal(left)
        for doc_id, start, total, ids in rest:
            while len(ids):
                n = min(room, len(ids))
                window.append((doc_id, start, total, ids[:n]))
                start, ids, room = start + n, ids[n:], room - n
                if not room:
                    self.done.append(window)
                    left -= goal
                    window, room = [], self.goal(left)
                    goal = room

    def goal(self, left: int) -> int:
        return self.size if left >= self.size else 1 << (left.bit_length() - 1) if left else 0

    def take(self) -> list[list]:
        done, self.done = self.done, []
        return done


def rows_of(part: int, first: int, windows: list[list], closed: bool, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in FIELDS]
    for k, pieces in enumerate(windows):
        offset = 0
        for doc_id, start, total, ids in pieces:
            raw = ids.astype("<u4").tobytes()
            row = (part, first + k, closed, doc_id, start, len(ids), total, offset, zlib.crc32(raw), raw if keep_ids or not closed else None)
            for c, v in zip(columns, row):
                c.append(v)
            offset += len(ids)
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=FIELDS)


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    most_open: int = OPEN,
    fan_in: int = FAN_IN,
    slack: int = SLACK,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of all documents: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids``.

    Every id of every document (its text's ids and the end id) lies in exactly one piece; a piece
    is a run of one document's ids inside one sequence. Sequence ids count from 0 without gaps; the
    offsets within a sequence do, too. A sequence shorter than ``size`` is padded to it unless its
    length is a power of two; at most ``slack`` ids are padded in a window that a task emits.

    A task holds ``most_open`` windows at most, and a merging task those of ``fan_in`` tasks,
    whatever the size of the table. ``ids`` (unsigned 32-bit, little-endian) are returned unless
    ``with_ids`` is false. Null text counts as empty: its document is the end id alone. A null
    id is kept as null, repeated rows are packed each, an empty table gives no pieces, a document
    longer than a window fills whole windows first. Other columns are ignored.
    """

    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, packer, found, n = TaskContext.get().partitionId(), Packer(size, most_open, slack), encoder(vocabulary), 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, texts in text_slices(batch.column(1)):
                ids, edges = found.encode(texts)
                for i in range(len(texts)):
                    mine = np.append(ids[edges[i] : edges[i + 1]], np.uint32(end_id))
                    packer.add(names[first + i], 0, len(mine), mine)
                done = packer.take()
                yield from rows_of(part, n, done, True, with_ids)
                n += len(done)
        yield from rows_of(part, n, [w[1] for w in packer.open], False, with_ids)

    with_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    level = stage(rows.mapInArrow(frugal(tasks), PIECES), "packed")
    closed = [level.where("closed")]
    while True:
        last = level.agg(F.max("part")).first()[0] or 0
        level = stage(merged(level.where(~F.col("closed")), last < fan_in, size, most_open, fan_in, slack, with_ids), "packed")
        closed.append(level.where("closed"))
        if last < fan_in:
            break
    numbered = [p.withColumn("_level", F.lit(k)) for k, p in enumerate(closed)]
    whole = numbered[0]
    for more in numbered[1:]:
        whole = whole.unionByName(more)
    counts = whole.groupBy("_level", "part").agg((F.max("seq") + 1).alias("_n"))
    earlier = Window.orderBy("_level", "part").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(counts.select("_level", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")), "parts")
    out = whole.join(small_side(base), ["_level", "part"]).withColumn("sequence_id", F.col("_base") + F.col("seq"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)


def merged(left: DataFrame, final: bool, size: int, most_open: int, fan_in: int, slack: int, with_ids: bool) -> DataFrame:
    """Pack the open windows of ``fan_in`` tasks again; the last group closes all."""

    def group(key: tuple, table: pa.Table) -> pa.Table:
        packer = Packer(size, most_open, slack)
        ordered = table.sort_by([("part", "ascending"), ("seq", "ascending"), ("offset", "ascending")])
        for row in ordered.select(["doc_id", "start", "doc_tokens", "ids"]).to_pylist():
            packer.add(row["doc_id"], row["start"], row["doc_tokens"], np.frombuffer(row["ids"], "<u4"))
        if final:
            packer.finish()
        done = packer.take()
        part = key[0].as_py()
        batches = [*rows_of(part, 0, done, True, with_ids), *rows_of(part, len(done), [w[1] for w in packer.open], False, with_ids)]
        return pa.Table.from_batches(batches, pa.schema(list(zip(FIELDS, TYPES))))

    return left.groupBy(F.floor(F.col("part") / fan_in).cast("int").alias("_group")).applyInArrow(group, PIECES)
