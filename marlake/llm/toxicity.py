"""Toxicity scores: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed n-gram in a text. Its scale is the log ratio of its smoothed
document counts in the two classes; features that a likelihood-ratio test does not tell from
chance (``Z`` standard deviations) are left out. A logistic regression on the scaled features gives the score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import frugal, text_slices, with_package
from marlake.session import stage

ORDERS = (3, 4, 5)
BITS = 20
SMOOTHING = 0.5
Z = 3.0
MOST_PER_CLASS = 10_000
REGULARISATION = 1e-4
SLICE = 1 << 20


def gram_places(texts: pa.Array, orders: Sequence[int] = ORDERS, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the text and the bucket of every character n-gram (lower case, runs of blanks as one, a blank at both ends)."""
    plain = pc.binary_join_element_wise("", pc.replace_substring_regex(pc.utf8_lower(texts), r"[\s]+", " "), "", " ")
    lengths = pc.utf8_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(plain.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    rest = np.repeat(np.cumsum(lengths, dtype=np.int32), lengths) - np.arange(len(points), dtype=np.int32)  # characters to the end of the text
    rolled = np.zeros(len(points), np.uint32)
    for n in range(1, max(orders) + 1):
        ahead = np.zeros(len(points), np.uint32)
        ahead[: len(points) - n + 1] = points[n - 1 :]
        rolled = rolled * np.uint32(0x01000193) + ahead + np.uint32(n)
        if n in orders:
            whole = rest >= n
            yield owner[whole], ((rolled[whole] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int32)


def features_of(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every distinct feature of every text; only ``wanted`` buckets if given (a mask)."""
    found = []
    for owner, bucket in gram_places(texts):
        if wanted is not None:
            hit = wanted[bucket]
            owner, bucket = owner[hit], bucket[hit]
        found.append(np.unique(owner.astype(np.int64) << BITS | bucket))
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    """Weight (regression coefficient times log-count ratio) of each bucket in use, and the intercept."""

    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = 0.0

    def score(self, texts: pa.Array) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.buckets] = self.weights
        owner, bucket = features_of(texts, table != 0)
        total = self.intercept + np.bincount(owner, table[bucket], len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def held_out(id_col: Column) -> Column:
    """Whether a document is kept for testing: crc32 of its id as text is a multiple of five; not for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """Text, label and weight of the sampled labelled rows, written.

    Labels of held-out ids are never read. Of each class about ``most`` rows are taken by a hash of
    their id, all if there are fewer; weights restore the classes' shares. An id with several
    labels counts as toxic if any is.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
    known = stage(known.groupBy("_id").agg(F.max("_label").alias("_label")), "labels")
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    share = F.lit(1.0)
    for label, n in counts.items():
        share = F.when(F.col("_label") == label, F.lit(min(1.0, most / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < share).withColumn("_weight", 1 / share)  # about 2 * most narrow rows
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    return stage(rows.join(F.broadcast(sample), "_id").select("_text", "_label", "_weight"), "training")


def deviance(bad: Column, good: Column, n_bad: int, n_good: int) -> Column:
    """Twice the log-likelihood ratio of two shares, bad of n_bad and good of n_good, against one common share."""
    n = n_bad + n_good
    total = F.lit(0.0)
    for seen, size in ((bad, n_bad), (good, n_good)):
        with_it, without_it = (bad + good) * size / n, (n - bad - good) * size / n
        total += F.when(seen > 0, seen * F.log(seen / with_it)).otherwise(0.0)
        total += F.when(seen < size, (size - seen) * F.log((size - seen) / without_it)).otherwise(0.0)
    return 2 * total


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_PER_CLASS) -> Model:
    """Train on at most about ``most`` labelled rows of each class.

    Only texts and labels enter. Without rows of both classes the model is a constant: the smoothed
    share of the class that is there, one half without any labelled row.
    """
    with_package(docs.sparkSession)
    rows = training_rows(docs, labels, id_col, text_col, label_col, most)
    sizes = {r["_label"]: (r["n"], r["w"]) for r in rows.groupBy("_label").agg(F.count("*").alias("n"), F.sum("_weight").alias("w")).collect()}
    (n_bad, _), (n_good, _) = sizes.get(1, (0, 0)), sizes.get(0, (0, 0))
    if not n_bad or not n_good:
        return Model(intercept=float(np.log((n_bad + 1) / (n_good + 1))))
    rows = rows.repartition(max(1, min(16, (n_bad + n_good) // 500)))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for first, texts in text_slices(batch.column(0), SLICE):
                owner, bucket = features_of(texts)
                mine = label[first + owner]
                for k in (0, 1):
                    seen[k] += np.bincount(bucket[mine == k], minlength=1 << BITS)
        used = np.nonzero(seen.sum(axis=0))[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[1][used]), pa.array(seen[0][used])], names=["bucket", "bad", "good"])

    counts = rows.mapInArrow(frugal(count), "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    ratio = F.log((F.col("bad") + SMOOTHING) / (n_bad + 2 * SMOOTHING)) - F.log((F.col("good") + SMOOTHING) / (n_good + 2 * SMOOTHING))
    told = counts.select("bucket", ratio.alias("r"), deviance(F.col("bad"), F.col("good"), n_bad, n_good).alias("g"))
    chosen = told.where(F.col("g") > Z * Z).select("bucket", "r").toArrow()
    used = chosen["bucket"].to_numpy()  # at most one per bucket
    ratios = chosen["r"].to_numpy()[np.argsort(used)]
    used = np.sort(used)
    if not len(used):
        return Model(intercept=float(np.log((n_bad + 1) / (n_good + 1))))

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, np.int32)
        place[used] = np.arange(len(used))
        for batch in batches:
            for first, texts in text_slices(batch.column(0), SLICE):
                owner, bucket = features_of(texts, place >= 0)
                edges = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(edges), pa.array(place[bucket]))
                label, weight = (batch.column(i).slice(first, len(texts)) for i in (1, 2))
                yield pa.RecordBatch.from_arrays([label, weight, found], names=["label", "weight", "found"])

    n = len(used)
    scale = ratios.tolist()
    sparse = F.udf(lambda found: Vectors.sparse(n, found, [scale[i] for i in found]), VectorUDT())
    table = stage(rows.mapInArrow(frugal(features), "label int, weight double, found array<int>"), "features")
    table = table.select("label", "weight", sparse("found").alias("features"))
    model = LogisticRegression(labelCol="label", weightCol="weight", regParam=REGULARISATION, standardization=False, maxIter=60).fit(table)
    return Model(used, model.coefficients.toArray() * ratios, float(model.intercept))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every document row.

    Only the text enters a score; null counts as empty, whose score is that of the intercept.
    Whole texts are read, in slices of bounded size. Repeated rows get equal scores, an empty table
    gives none, other columns are ignored.
    """
    with_package(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(model.score(texts))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    scored = rows.mapInArrow(frugal(run), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
