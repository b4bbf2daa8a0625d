"""Selection by importance resampling: n-gram models of wanted and of all texts, Gumbel top-k.

Texts are cut into words and runs of marks; hashed unigrams and bigrams are counted over all
documents (the raw model) and over documents labelled as good (the target model). A document's
weight is the log ratio of its probabilities under the two models, the sum over its n-grams. Adding
Gumbel noise to the weights and taking the k largest draws k documents without replacement, in
proportion to the exponential of the weights, the ratio of the models.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import frugal, positions, text_slices, with_package
from marlake.session import stage

BUCKETS = 1 << 16
PSEUDO = 8.0
TEMPERATURE = 1.0
MOST_TARGET = 20_000
GOOD_WEIGHT = 4
MARKS = r"([^\p{L}\p{N}\s]+)"
SLICE = 2 << 20


def grams(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every unigram and bigram."""
    cut = pc.utf8_split_whitespace(pc.replace_substring_regex(texts, MARKS, r" \1 "))
    coded = cut.values.dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = pd.util.hash_array(np.array(names, dtype=object), categorize=False) if names else np.zeros(0, np.uint64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    counts = np.diff(cut.offsets.to_numpy())
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    real = (np.array([n != "" for n in names], bool) if names else np.zeros(0, bool))[codes]
    owner, one = owner[real], hashes[codes[real]]
    pair = owner[1:] == owner[:-1]
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])[pair]
    two = (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    both = np.concatenate([one, two])
    return np.concatenate([owner, owner[1:][pair]]), ((both >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def log_ratio(raw: np.ndarray, target: np.ndarray, pseudo: float = PSEUDO) -> np.ndarray:
    """Log ratio of the models per bucket; both get ``pseudo`` expected counts, so rare n-grams say little."""
    share = target.sum() / max(1, raw.sum())
    return np.log((target + pseudo) / (share * raw + pseudo)) if share > 0 else np.zeros(len(raw))


def target_ids(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """Ids with a label, ``_good`` 0 or 1 (0 if any label says so); about ``most`` of each, drawn by a hash of the id.

    Half of them are marked ``_fit``: the target model is made from their good ones, and the cut between good and
    bad is set on the others, whose texts the model has not seen.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_good"))
    known = known.where(F.col("_id").isNotNull() & F.col("_good").isin(0, 1)).groupBy("_id").agg(F.min("_good").alias("_good"))
    known = stage(known, "labels")
    share = F.lit(1.0)
    for r in known.groupBy("_good").count().collect():
        share = F.when(F.col("_good") == r["_good"], F.lit(min(1.0, most / r["count"]))).otherwise(share)
    drawn = known.where(F.pmod(F.xxhash64("_id", F.lit(23)), F.lit(1 << 30)) / float(1 << 30) < share)
    return drawn.withColumn("_fit", F.pmod(F.xxhash64("_id", F.lit(29)), F.lit(2)) == 0)


def count_models(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all rows and over the good ones that the target model is made from; one sum per task and bucket is shuffled, ``buckets`` rows are fetched."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = pc.equal(batch.column(1), 1).fill_null(False).to_numpy(zero_copy_only=False)
            for first, texts in text_slices(batch.column(0), SLICE):
                owner, bucket = grams(texts, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[good[first + owner]], minlength=buckets)
        used = np.nonzero(raw)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    sums = rows.select("_text", F.when(F.col("_fit"), F.col("_good")).alias("_good")).mapInArrow(frugal(count), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = sums.toArrow()
    out = np.zeros((2, buckets))
    out[0, found["bucket"].to_numpy()] = found["raw"].to_numpy()
    out[1, found["bucket"].to_numpy()] = found["target"].to_numpy()
    return out[0], out[1]


def cut_of(good: np.ndarray, bad: np.ndarray) -> float:
    """The mean log ratio that parts labelled good from labelled bad documents best: a share of good ones lost counts ``GOOD_WEIGHT`` times a share of bad ones kept."""
    if not len(good) or not len(bad):
        return -np.inf
    values = np.sort(np.concatenate([good, bad]))
    middles = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2])
    kept = 1 - np.searchsorted(np.sort(good), middles) / len(good)
    gone = np.searchsorted(np.sort(bad), middles) / len(bad)
    return float(middles[np.argmax(GOOD_WEIGHT * kept + gone)])


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep: int | float | None = None,
    floor: bool = True,
    seed: int = 11,
    buckets: int = BUCKETS,
    temperature: float = TEMPERATURE,
    most_target: int = MOST_TARGET,
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_grams``, ``weight``, ``noisy``, ``above_floor`` and ``kept`` of every document row.

    ``weight`` is the document's log ratio (0 for a text without an n-gram), ``noisy`` is weight / ``temperature`` plus
    Gumbel noise drawn from a hash of (id, text, seed). The k rows of largest ``noisy`` are kept: at the temperature of 1
    they are drawn by the ratio of the models itself; a higher one draws more evenly, a lower one comes closer to the
    largest weights. A long text is weighed whole, so its weight lies further from 0 than that of a short one.

    ``floor`` lets only documents be drawn whose mean log ratio per n-gram, which does not depend on their length, is
    above the cut that best parts labelled good from labelled bad documents that the target model has not seen.
    ``keep`` is k, or as a fraction the share of the rows above the floor; left out, all of these are drawn.
    The raw counts, weights and the top-k cover all documents; the target model is fit on about ``most_target``
    documents of each label at most.

    Null text counts as empty. Repeated rows share weight and noise, so they are kept or dropped
    together but for a tie at the last place, which goes by id (null first). Without any
    label all documents are above the floor. A very long text is cut into n-grams whole. An empty table gives no rows; other columns are ignored.
    ``text_hash`` tells rows of one id apart.
    """
    with_package(docs.sparkSession)
    known = stage(target_ids(labels, id_col, label_col, most_target), "target")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    raw, target = count_models(rows.join(F.broadcast(known), "_id", "left"), buckets)  # at most about 2 * most_target ids
    ratio = log_ratio(raw, target).astype(np.float32)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE):
                owner, bucket = grams(texts, buckets)
                n = np.bincount(owner, minlength=len(texts))
                weight = np.bincount(owner, ratio[bucket], len(texts))
                own = [batch.column(i).slice(first, len(texts)) for i in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n.astype(np.int64)), pa.array(weight)], names=["doc_id", "text_hash", "_draw", "n_grams", "weight"])

    drawn = rows.select("_id", "_text", F.xxhash64("_text").alias("_th"), F.xxhash64("_id", "_text", F.lit(seed)).alias("_draw"))
    weighed = drawn.mapInArrow(frugal(weigh), "doc_id long, text_hash long, _draw long, n_grams long, weight double")
    uniform = (F.pmod(F.col("_draw"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noisy = F.col("weight") / temperature - F.log(-F.log(uniform))
    weighed = stage(weighed.select("doc_id", "text_hash", "n_grams", "weight", noisy.alias("noisy"), F.lit(1).cast("long").alias("_one"), F.monotonically_increasing_id().alias("_place")), "weights")
    mean = F.col("weight") / F.greatest(F.col("n_grams"), F.lit(1))
    cut = -np.inf
    if floor:
        judged = weighed.join(F.broadcast(known), weighed["doc_id"] == known["_id"]).where("not _fit").groupBy("_good", "doc_id").agg(F.min(mean).alias("mean")).toArrow()
        good, means = judged["_good"].to_numpy(), judged["mean"].to_numpy()
        cut = cut_of(means[good == 1], means[good == 0])
    weighed = weighed.withColumn("above_floor", mean >= cut)
    above = weighed.where("above_floor").count()
    most = above if keep is None else math.ceil(keep * above) if isinstance(keep, float) else min(keep, above)
    ranked = positions(weighed, [F.col("above_floor").desc(), F.col("noisy").desc(), F.col("doc_id").asc_nulls_first(), F.col("_place")], "_one")  # the place parts equal rows
    return ranked.select("doc_id", "text_hash", "n_grams", "weight", "noisy", "above_floor", (F.col("_rank") < most).alias("kept"))
