"""Runs of words that repeat with a period: recursive frequency splitting, then a scan over lags.

A run is a stretch of words with smallest period q that is at least ``min_words`` and twice q long
and that no neighbouring word extends. Each of its words stands again q words before or after it,
inside the run. So a word without another occurrence within half a segment's length, inside that
segment, belongs to no run and splits the segment; the pieces are judged again by their own
lengths and borders until nothing changes. What survives is compared with itself at every lag.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import frugal, text_slices, with_package, words

MIN_WORDS = 12
GRAM = 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def surviving(codes: np.ndarray, min_words: int) -> Iterator[tuple[int, int]]:
    """Segments (start, end) in which every word stands again near enough; no run reaches beyond them."""
    n = len(codes)
    once = np.flatnonzero(np.bincount(codes)[codes] == 1)
    if np.diff(once, prepend=-1, append=n).max() <= min_words:
        return
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    earlier, later = np.full(n, -1), np.full(n, n)
    earlier[order[1:][same]] = order[:-1][same]
    later[order[:-1][same]] = order[1:][same]
    place = np.arange(n)
    todo = [(0, n)]
    while todo:
        start, end = todo.pop()
        half = (end - start) // 2
        at = place[start:end]
        rare = (earlier[start:end] < np.maximum(at - half, start)) & (later[start:end] > np.minimum(at + half, end - 1))
        cuts = np.flatnonzero(rare)
        if not len(cuts):
            yield start, end
            continue
        edges = np.concatenate([[-1], cuts, [end - start]])
        for k in np.flatnonzero(np.diff(edges) > min_words):
            todo.append((start + int(edges[k]) + 1, start + int(edges[k + 1])))


def matched(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The whole stretch around ``at`` in which each word equals the one ``lag`` words later."""
    high, step = at, 64
    while high + lag < len(codes):
        differ = codes[high : high + step][: len(codes) - lag - high] != codes[high + lag : high + lag + step]
        if differ.any():
            high += int(differ.argmax())
            break
        high, step = high + len(differ), step * 2
    low, step = at, 64
    while low > 0:
        first = max(0, low - step)
        differ = codes[first:low] != codes[first + lag : low + lag]
        if differ.any():
            low -= int(differ[::-1].argmax())
            break
        low, step = first, step * 2
    return low, high


def scan(codes: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a segment.

    At a lag, a run shows as a stretch of at least ``need`` matches. Matches of ``GRAM`` words are
    looked up at so many places only that each such stretch holds one, which makes all lags
    together cost n log n; a place that matches is followed in both directions. A place inside a
    run whose period divides the lag can only show that run again.
    """
    n = len(codes)
    found: dict[tuple[int, int], int] = {}
    live: list[tuple[int, int, int]] = []
    c = codes.astype(np.uint64)
    grams = np.zeros(max(0, n - GRAM + 1), np.uint64)
    for k in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + c[k : k + len(grams)]
    for lag in range(1, n // 2 + 1):
        need = max(min_words - lag, lag)
        values, step = (grams, need - GRAM + 1) if need >= GRAM else (c, need)
        hits = np.flatnonzero(values[: max(0, len(values) - lag) : step] == values[lag::step]) * step
        if not len(hits):
            continue
        live = [r for r in live if r[1] - r[0] > lag]
        for start, end, period in live:
            if lag % period == 0:
                hits = hits[(hits < start) | (hits + lag >= end)]
        k = 0
        while k < len(hits):
            low, high = matched(codes, int(hits[k]), lag)
            if high - low >= need and (low, high + lag) not in found:
                found[low, high + lag] = lag
                live.append((low, high + lag, lag))
            k = max(k + 1, int(np.searchsorted(hits, high)))
    return [(start, end - start, period) for (start, end), period in found.items()]


def runs_of(texts: list[bytes], min_words: int) -> list[tuple[int, int, int]]:
    """All runs of a list of words, by start, then period."""
    if len(texts) < min_words:
        return []
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for w in texts), np.int64, len(texts))
    runs = [(start + s, n, q) for start, end in surviving(codes, min_words) for s, n, q in scan(codes[start:end], min_words)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(texts: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(texts)
    depth = np.zeros(len(texts) + 1, np.int64)
    for start, n, period in runs:
        depth[start + period] += 1
        depth[start + n] -= 1
    stays = np.cumsum(depth[:-1]) == 0
    return b" ".join(w for w, keep in zip(texts, stays.tolist()) if keep)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, with_text: bool = True
) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` holds (start, length, period) of every run, in words, by start and then period;
    ``collapsed`` is the text's words joined by one space without those that any run holds after
    its first period (null unless ``with_text``). Words are runs of anything but ASCII blanks.

    Each row is judged by itself, so nothing is shuffled. Texts are read in slices of bounded
    bytes; a longer one stands alone, and takes memory in proportion to its words and time in
    proportion to n log n, besides the borders that its runs really have.

    Null and empty texts, and texts of blanks, have no words: no runs, and an empty ``collapsed``.
    Runs of equal start are told apart by their periods; two runs never share start and end.
    Repeated rows, rows without an id and rows that share one each get a row of their own. An
    empty table gives no rows. Other columns are ignored, whatever their names.
    """
    if min_words < 2:
        raise ValueError("a run has two words at least")

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                counts, runs, left = [], [], []
                for text in texts.cast(pa.binary()).to_pylist():
                    own = text.split()
                    found = runs_of(own, min_words)
                    counts.append(len(own))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    left.append(collapsed(own, found).decode() if with_text else None)
                columns = [batch.column(0).slice(first, len(texts)), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    with_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(frugal(judge), schema)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` in which each tenth document, by the crc32 of its id, repeats from some word on.

    With h the checksum and g = floor(h / 10), word i from a = g % n on becomes word a + (i - a) % p,
    with p = 1 + floor((n - a) / (3 + g % 8)). Texts without words, and rows without an id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("h", h)
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words(F.col("text"))))
    n, g = F.size("w"), F.floor(F.col("h") / 10).cast("long")
    rows = rows.withColumns({"n": n, "a": (g % n).cast("int")})
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    again = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", source(i, F.col("a"), F.col("p"))))
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def source(i: Column, a: Column, p: Column) -> Column:
    return F.when(i < a, i).otherwise(a + (i - a) % p)


def longest(runs: Column) -> Column:
    """The run of greatest length; the least start, then the least period, among equals."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(ranked)
