"""Benchmark decontamination by latent semantic retrieval.

Texts become sequences of normalised words; only words that some benchmark item has can add to a
similarity with an item, so documents are reduced to these words and their places, once. Blocks of
``BLOCK`` words are the rows of a TF-IDF matrix (passage frequencies over all documents). A
randomised SVD of this matrix, in one distributed pass (test matrix, product with the Gram
matrix, Nyström factors), gives a latent space; the items' own blocks are rows of it too, and
weigh ``ITEM_POWER`` times as much as all documents together, so that the space holds what tells items apart. Two neighbouring blocks
of an item and three of a document make a passage, so that no offset cuts one; a passage whose cosine with a passage of an item is high enough, and which holds enough of its length, is a candidate. A candidate is
confirmed by the longest common subsequence of the item and the words around the place, weighted
by inverse frequency: either most of the item is there, or about half of it together with its
answer (a paraphrase).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import frugal, positions, small_side, text_slices, with_package
from marlake.session import stage

BLOCK = 16
SPAN = 3
RANK = 128
OVERSAMPLE = 16
COPIED = 0.8
PARAPHRASED = 0.5
# What is left of an item may be dealt unevenly over its passages, and its frequent words weigh less: so much of the share lies in one passage.
PLACED = 0.7
# A passage of a document is half as long again as one of an item.
COSINE = PLACED * PARAPHRASED * (2 / SPAN) ** 0.5
ANSWERED = 0.8
FEW_WORDS = 8
# A word of every block still counts that much.
LEAST_WEIGHT = 0.05
ITEM_POWER = 4
# Words of a slice: the arrays of a slice hold that many rows of the latent width.
WORDS = 1 << 16
ITEMS = 256
QUERIES = 64
FAN_IN = 64
CHUNK = 1024
ENCODED = "row long, n_words int, gaps array<int>, codes array<int>"


def normalised(words: pa.Array) -> pa.Array:
    """Lower case, letters and digits only."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{N}]+", "")


def words_of(text: str) -> list[str]:
    found = normalised(pa.array((text or "").split(), pa.string())).to_pylist()
    return [w for w in found if w]


@dataclass
class Items:
    """A block of benchmark items over one vocabulary."""

    ids: list[int]
    words: list[np.ndarray]  # codes of each item
    answers: list[np.ndarray]  # codes of each item's answer, in order
    vocabulary: pa.Array


def items_of(rows: list) -> Items:
    """Items with at least one word; the answer is the given one, else the item's last sentence."""
    texts = [(r["item_id"], words_of(r["text"]), words_of(r["answer"] if r["answer"] else last_sentence(r["text"]))) for r in rows]
    texts = [t for t in texts if t[1]]
    names = sorted({w for _, words, answer in texts for w in (*words, *answer)})
    code = {w: i for i, w in enumerate(names)}
    as_codes = lambda words: np.array([code[w] for w in words], np.int64)
    return Items([t[0] for t in texts], [as_codes(t[1]) for t in texts], [as_codes(t[2]) for t in texts], pa.array(names, pa.string()))


def last_sentence(text: str | None) -> str:
    parts = [p for p in (text or "").replace("\n", ". ").replace("?", ".").replace("!", ".").split(". ") if words_of(p)]
    return parts[-1] if parts else ""


def encode(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``docs`` (columns row, text) as the places and codes of the vocabulary's words; place k is the k-th blank-separated word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                cut = pc.ascii_split_whitespace(texts)
                coded = cut.values.dictionary_encode()
                known = pc.index_in(normalised(coded.dictionary), value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
                codes = known[coded.indices.to_numpy(zero_copy_only=False)]
                edges = cut.offsets.to_numpy().astype(np.int64)
                edges = edges - edges[0]
                hit = np.nonzero(codes >= 0)[0]
                bounds = np.searchsorted(hit, edges)
                gaps = np.diff(hit, prepend=0)
                full = np.nonzero(bounds[1:] > bounds[:-1])[0]  # the first gap of a text counts from its own start
                gaps[bounds[:-1][full]] = hit[bounds[:-1][full]] - edges[:-1][full]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(np.diff(edges).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(gaps.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(codes[hit].astype(np.int32))),
                    ],
                    names=["row", "n_words", "gaps", "codes"],
                )

    return docs.mapInArrow(frugal(run), ENCODED)


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoded batches cut into runs of texts with about ``WORDS`` words, so that a task holds few of them at once."""
    for batch in batches:
        ends = batch.column(2).offsets.to_numpy()[1:].astype(np.int64)
        first = 0
        while first < len(batch):
            begun = ends[first - 1] if first else batch.column(2).offsets[0].as_py()
            last = max(first + 1, int(np.searchsorted(ends, begun + WORDS, side="right")))
            yield batch.slice(first, last - first)
            first = last


def opened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of an encoded batch: the bounds of its texts, and for each word its text, its place and its code."""
    lists = batch.column(2)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    gaps = lists.values.to_numpy()[bounds[0] : bounds[-1]].astype(np.int64)
    codes = batch.column(3).values.to_numpy()[bounds[0] : bounds[-1]].astype(np.int64)
    bounds = bounds - bounds[0]
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    run = np.concatenate([[0], np.cumsum(gaps)])
    place = run[1:] - np.repeat(run[bounds[:-1]], counts)
    return bounds, owner, place, codes


def blocks_of(owner: np.ndarray, place: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The running number of each word's block, and the first block of each text (with the end)."""
    first = np.concatenate([[0], np.cumsum((n_words.astype(np.int64) + BLOCK - 1) // BLOCK)])
    return first[owner] + place // BLOCK, first


def frequencies(encoded: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Number of blocks with each word, and of all blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(size + 1, np.int64), 0
        for batch in sliced(batches):
            _, owner, place, codes = opened(batch)
            block, first = blocks_of(owner, place, batch.column(1).to_numpy())
            pairs = np.unique(block * size + codes)
            seen[:size] += np.bincount(pairs % size, minlength=size)
            total += int(first[-1])
        seen[size] = total
        used = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], names=["code", "n"])

    found = encoded.mapInArrow(frugal(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    out[found["code"].to_numpy()] = found["n"].to_numpy()
    return out[:size], int(out[size])


def idf_of(df: np.ndarray, total: int) -> np.ndarray:
    return np.log((1 + total) / (1 + df))


def block_sums(rows: np.ndarray, table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending ``rows`` and, for each, the sum of the table's lines of its codes."""
    if not len(rows):
        return rows, np.zeros((0, table.shape[1]), table.dtype)
    starts = np.nonzero(np.diff(rows, prepend=-1))[0]
    return rows[starts], np.add.reduceat(table[codes], starts, axis=0)


def gram_product(rows: np.ndarray, codes: np.ndarray, weight: np.ndarray, test: np.ndarray) -> np.ndarray:
    """(A' A) times ``test`` for the rows given by (row, code) pairs, A having ``weight`` per code."""
    kept, sums = block_sums(rows, weight[:, None] * test, codes)
    order = np.argsort(codes, kind="stable")
    named = codes[order]
    starts = np.nonzero(np.diff(named, prepend=-1))[0]
    totals = np.add.reduceat(sums[np.searchsorted(kept, rows[order])], starts, axis=0)
    out = np.zeros_like(test)
    out[named[starts]] = totals * weight[named[starts]][:, None]
    return out


def latent_space(encoded: DataFrame, items: Items, weight: np.ndarray, df: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Right singular vectors of the TF-IDF blocks of all documents and items, times the word weights.

    Each task multiplies its own rows with the test matrix and back; the products are added up in
    groups of ``FAN_IN`` tasks and ``CHUNK`` words until one is left.
    """
    size = len(weight)
    width = min(rank + OVERSAMPLE, size)
    test = np.random.default_rng(seed).standard_normal((size, width)).astype(np.float32)
    used = weight > 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, width), np.float32)
        for batch in sliced(batches):
            _, owner, place, codes = opened(batch)
            block, _ = blocks_of(owner, place, batch.column(1).to_numpy())
            own = used[codes]
            if own.any():
                total += gram_product(block[own], codes[own], weight, test)
        part = TaskContext.get().partitionId()
        for k in range(0, size, CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k // CHUNK], pa.int32()), pa.array([total[k : k + CHUNK].tobytes()], pa.binary())], names=["part", "chunk", "sums"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32) for x in table["sums"].to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "chunk": pa.array([key[1].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    sums = stage(encoded.mapInArrow(frugal(run), "part int, chunk int, sums binary"), "products")
    while (sums.agg(F.max("part")).first()[0] or 0) > 0:
        group = F.floor(F.col("part") / FAN_IN).cast("int").alias("_group")
        sums = stage(sums.groupBy(group, "chunk").applyInArrow(add, "part int, chunk int, sums binary"), "products")
    product = np.zeros((size, width), np.float64)
    for row in sums.collect():  # words of the benchmark times the rank
        product[row["chunk"] * CHUNK :][:CHUNK] = np.frombuffer(row["sums"], np.float32).reshape(-1, width)
    rows = np.concatenate([np.full(len(w), i) * 1_000_000 + np.arange(len(w)) // BLOCK for i, w in enumerate(items.words)])
    codes = np.concatenate(items.words)
    own = used[codes]
    if own.any():
        power = ITEM_POWER * (df * weight**2).sum() / (weight[codes[own]] ** 2).sum()
        product += max(power, 1e-6) * gram_product(rows[own], codes[own], weight.astype(np.float64), test.astype(np.float64))
    return (nystrom(product, test.astype(np.float64), rank) * weight[:, None]).astype(np.float32)


def nystrom(product: np.ndarray, test: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of a positive matrix G from G times a test matrix (single pass, with a small shift)."""
    shift = np.sqrt(product.shape[0]) * np.finfo(np.float32).eps * max(np.linalg.norm(product), 1e-12)
    shifted = product + shift * test
    small = test.T @ shifted
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    good = values > values[-1] * 1e-9
    basis = shifted @ (vectors[:, good] / np.sqrt(values[good]))
    left, _, _ = np.linalg.svd(basis, full_matrices=False)
    return left[:, :rank]


def queries_of(items: Items, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit latent vectors of the items' passages (two blocks, one block apart), the length, the item and the first word of each; ascending length."""
    vectors, owner, start = [], [], []
    for i, codes in enumerate(items.words):
        last = max(1, (len(codes) - 1) // BLOCK) if len(codes) > BLOCK else 1
        for k in range(last):
            vectors.append(space[codes[k * BLOCK : (k + 2) * BLOCK]].sum(axis=0))
            owner.append(i)
            start.append(k * BLOCK)
    found = np.array(vectors, np.float32).reshape(len(vectors), space.shape[1])
    norms = np.linalg.norm(found, axis=1)
    order = np.argsort(norms, kind="stable")
    unit = found / np.maximum(norms, 1e-12)[:, None]
    return unit[order], norms[order], np.array(owner, np.int64)[order], np.array(start, np.int64)[order]


def common_share(item: np.ndarray, region: np.ndarray, weight: np.ndarray) -> float:
    """Weight of the heaviest common subsequence as a share of the item's weight."""
    line = np.zeros(len(region) + 1)
    for code in item:
        taken = np.concatenate([[0.0], line[:-1] + (region == code) * weight[code]])
        line = np.maximum.accumulate(np.maximum(line, taken))
    return float(line[-1] / max(weight[item].sum(), 1e-12))


def most_common(bag: tuple[np.ndarray, np.ndarray], region: np.ndarray, weight: np.ndarray) -> float:
    """Weight of the words that the item and the region share in any order; no common subsequence is heavier."""
    codes, counts = bag
    return float(np.minimum(np.bincount(region, minlength=len(weight))[codes], counts) @ weight[codes])


def search(encoded: DataFrame, items: Items, space: np.ndarray, weight: np.ndarray, idf: np.ndarray, cosine: float, copied: float, paraphrased: float, answered: float) -> DataFrame:
    """(row, item_id, cosine, share, answer) of confirmed places; a document and item may come more than once."""
    queries, lengths, owner_of, start_of = queries_of(items, space)
    mass = np.maximum(idf, LEAST_WEIGHT)
    contained = PLACED * min(copied, paraphrased)
    bags = [np.unique(words, return_counts=True) for words in items.words]
    # No place with a smaller share of an item is confirmed.
    least = [(min(copied, paraphrased) if len(words) >= FEW_WORDS else 1) * mass[words].sum() - 1e-6 for words in items.words]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            bounds, owner, place, codes = opened(batch)
            n_words = batch.column(1).to_numpy()
            block, first = blocks_of(owner, place, n_words)
            own = weight[codes] > 0
            kept, sums = block_sums(block[own], space, codes[own])
            out: dict[tuple[int, int], tuple] = {}
            # A passage is three neighbouring blocks of a text, so that it holds an item's passage at any offset; it is named by its first block.
            text = np.searchsorted(first, kept, side="right") - 1
            heads = np.unique(np.concatenate([(kept - d)[kept - d >= first[text]] for d in range(SPAN)]))
            last = first[np.searchsorted(first, heads, side="right")]
            at = [np.searchsorted(kept, heads + d) for d in range(SPAN)]
            has = [(a < len(kept)) & (heads + d < last) for d, a in enumerate(at)]
            if len(kept):
                has = [h & (kept[np.minimum(a, len(kept) - 1)] == heads + d) for d, (h, a) in enumerate(zip(has, at))]
            for k in range(0, len(heads), 20_000):
                part = slice(k, k + 20_000)
                passage = np.zeros((len(heads[part]), space.shape[1]), np.float32)
                for h, a in zip(has, at):
                    passage[h[part]] += sums[a[part][h[part]]]
                length = np.linalg.norm(passage, axis=1)
                for p in range(0, len(queries), QUERIES):
                    # A passage shorter than that cannot hold enough of any of these queries.
                    long = np.nonzero(length >= max(contained * lengths[p], 1e-9))[0]
                    dots = passage[long] @ queries[p : p + QUERIES].T
                    right = (dots >= cosine * length[long][:, None]) & (dots >= contained * lengths[p : p + QUERIES])
                    for i, j in zip(*np.nonzero(right)):
                        head, query = int(heads[k + long[i]]), p + int(j)
                        row = int(np.searchsorted(first, head, side="right") - 1)
                        item = int(owner_of[query])
                        if out.get((row, item), (0, 0.0))[1] >= 1 - 1e-9:
                            continue
                        words = items.words[item]
                        begin = (head - first[row]) * BLOCK - int(start_of[query]) - BLOCK
                        a, b = bounds[row], bounds[row + 1]
                        lo, hi = a + np.searchsorted(place[a:b], [begin, begin + len(words) + 3 * BLOCK])
                        region = codes[lo:hi]
                        if most_common(bags[item], region, mass) < least[item]:
                            continue
                        share = common_share(words, region, mass)
                        answer = common_share(items.answers[item], region, mass) if len(items.answers[item]) else 0.0
                        need = copied if len(words) >= FEW_WORDS else 1 - 1e-9
                        found = share >= need or (len(words) >= FEW_WORDS and share >= paraphrased and answer >= answered)
                        if found and share > out.get((row, item), (0, 0.0))[1]:
                            out[row, item] = (float(dots[i, j] / length[long[i]]), share, answer)
            names = batch.column(0).to_pylist()
            rows = [(names[r], items.ids[i], *v) for (r, i), v in out.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))], names=["row", "item_id", "cosine", "share", "answer"])

    return encoded.mapInArrow(frugal(run), "row long, item_id long, cosine double, share double, answer double")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    answer_col: str | None = None,
    rank: int = RANK,
    cosine: float = COSINE,
    copied: float = COPIED,
    paraphrased: float = PARAPHRASED,
    answered: float = ANSWERED,
    items_at_once: int = ITEMS,
    seed: int = 5,
) -> DataFrame:
    """Per document row: ``doc_id``, ``text_hash``, ``contaminated``, ``item_ids`` (ascending) and ``best_share``.

    Every document is searched whole against every item; items are taken in blocks of
    ``items_at_once``, the only part of the benchmark that is sent to all tasks. Every word of an item
    enters the latent space and the subsequence; frequent words count less, by their inverse frequency, but none is left out.

    Null and empty texts are not contaminated; an item without a word, or with a null id, finds
    nothing. Repeated rows and repeated items are each treated alike and an item id is named once. Empty tables give
    no rows, or no findings. Other columns are ignored. ``text_hash`` tells rows of one id apart.
    """
    with_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    keys = F.struct("doc_id", "text_hash")
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"), F.lit(1).cast("long").alias("_one"))
    items = stage(positions(items.where("item_id is not null and text is not null").distinct(), [F.col("item_id"), F.xxhash64("text", "answer")], "_one"), "items")
    n_items = items.count()
    numbered = F.xxhash64(keys, F.lit(7))  # equal rows have equal results, so a key need not tell them apart
    rows = rows.withColumn("row", numbered)
    hits = None
    for k in range(0, n_items, items_at_once):
        block = items_of(items.where((F.col("_rank") >= k) & (F.col("_rank") < k + items_at_once)).collect())
        if not block.ids:
            continue
        encoded = stage(encode(rows.select("row", "_text"), block.vocabulary), "encoded")
        df, total = frequencies(encoded, len(block.vocabulary))
        idf = idf_of(df, total)
        weight = np.maximum(idf, LEAST_WEIGHT).astype(np.float32)
        space = latent_space(encoded, block, weight, df, rank, seed)
        found = stage(search(encoded, block, space, weight, idf, cosine, copied, paraphrased, answered), "hits")
        hits = found if hits is None else hits.unionByName(found)
    out = rows.select("doc_id", "text_hash", "row")
    if hits is None:
        none = F.array().cast("array<bigint>")
        return out.select("doc_id", "text_hash", F.lit(False).alias("contaminated"), none.alias("item_ids"), F.lit(0.0).alias("best_share"))
    per_row = stage(hits.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("best_share")), "found")
    out = out.join(small_side(per_row), "row", "left")
    return out.select(
        "doc_id",
        "text_hash",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("best_share", F.lit(0.0)).alias("best_share"),
    )
