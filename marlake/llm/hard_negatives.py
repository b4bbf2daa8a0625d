"""Hard negatives by integer scores, searched for with angular triangle filtering.

Every vector keeps its norm and its angles to a few reference directions. For two vectors the
angles to one direction bound the angle between them from both sides (|x - y| and x + y), so
their cosine lies in an interval; times the norms, and widened against rounding, that bounds the
score. In a piece of the table the rows stand by nearest direction and by angle to it, so the
rows whose bounds meet an anchor's window of wanted scores are one slice. Only slices are scored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlake.llm.common import frugal, small_side, with_package
from marlake.session import stage

DIRECTIONS = 16
SCALE = 256
# A scaled component beyond this takes its row out, so that no score leaves 64 bits.
MOST = 1 << 20
PIECE_BYTES = 32 << 20
LEAST_ROWS = 2048
ANCHORS = 64
TOGETHER = 16
# Angles are right to about 2e-8; scores to the last unit and a share of the norms.
ANGLE_SLACK = 1e-6
SCORE_SLACK = 1e-9
NO_ID = np.iinfo(np.int64).max
ANY = np.iinfo(np.int64).max


def matrix(column: pa.Array, width: int, dtype: type) -> np.ndarray:
    """A list column as rows of ``width`` values; shorter lists end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def angles_to(vectors: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles between rows and unit directions; 0 for a row without a direction of its own."""
    cosines = vectors @ directions.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1.0, 1.0)), 0.0)


@dataclass
class Piece:
    """Some rows of the table, by nearest direction and angle to it."""

    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    norms: np.ndarray
    angles: np.ndarray
    cells: list[tuple[int, int, int]]

    @staticmethod
    def of(vectors, ids, labels, norms, angles) -> Piece:
        nearest = angles.argmin(axis=1)
        own = angles[np.arange(len(angles)), nearest]
        order = np.lexsort((own, nearest))
        nearest = nearest[order]
        starts = np.flatnonzero(np.diff(nearest, prepend=-1))
        ends = np.append(starts[1:], len(nearest))
        cells = [(int(nearest[s]), int(s), int(e)) for s, e in zip(starts, ends)]
        return Piece(vectors[order], ids[order], labels[order], norms[order], own[order], cells)


def slices(norm, angle, low, high, norms, angles) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor, the rows of one cell whose score bounds meet [low, high].

    norm, angle, low, high -- of the anchors; norms, angles -- of the cell's rows, angles sorted.
    """
    least, most = float(norms.min()), float(norms.max())
    slack = 1.0 + SCORE_SLACK * norm * most
    with np.errstate(divide="ignore", invalid="ignore"):
        # The best score within an angle is reached by the longest row, a negative one by the shortest.
        reach = (low - slack) / (norm * np.where(low - slack > 0, most, least))
        part = (high + slack) / (norm * np.where(high + slack > 0, least, most))
    none = norm * most == 0
    reach = np.where(none | np.isnan(reach), -1.0, reach)
    part = np.where(none | np.isnan(part), 1.0, part)
    widest = np.arccos(np.clip(reach, -1.0, 1.0)) + ANGLE_SLACK
    nearest = np.arccos(np.clip(part, -1.0, 1.0)) - ANGLE_SLACK
    first = np.searchsorted(angles, np.maximum(angle - widest, nearest - angle), side="left")
    last = np.searchsorted(angles, angle + widest, side="right")
    return first, np.where(reach > 1.0, first, last)


def search(piece: Piece, vectors, ids, labels, norms, angles, lows, highs, keep: int, same: bool) -> tuple[np.ndarray, ...]:
    """The ``keep`` best rows of a piece in each score window [lows, highs] of each anchor.

    Rows have the anchor's label and another id (``same``), or another label. Returns anchor,
    window, score and id of what was found; better scores first, ties by the smaller id.
    """
    bound = float(np.abs(vectors).max(initial=0)) * float(np.abs(piece.vectors).max(initial=0)) * max(1, vectors.shape[1])
    kind = np.float64 if bound < 2**53 else np.int64
    mine, theirs = vectors.astype(kind), piece.vectors.astype(kind, copy=False)
    floors = lows.astype(np.int64)
    found = tuple(np.zeros(0, np.int64) for _ in range(4))
    near = np.argsort([angles[:, cell].min() for cell, _, _ in piece.cells])
    for cell, start, end in [piece.cells[i] for i in near]:
        open_ = floors <= highs
        low = np.where(open_, floors, ANY).min(axis=1).astype(np.float64)
        high = np.where(open_, highs, -ANY).max(axis=1).astype(np.float64)
        first, last = slices(norms, angles[:, cell], low, high, piece.norms[start:end], piece.angles[start:end])
        wanted = np.flatnonzero((first < last) & open_.any(axis=1))
        wanted = wanted[np.argsort(first[wanted], kind="stable")]
        for k in range(0, len(wanted), TOGETHER):
            some = wanted[k : k + TOGETHER]
            rows = slice(start + int(first[some].min()), start + int(last[some].max()))
            scores = (mine[some] @ theirs[rows].T).astype(np.int64)
            right = piece.labels[rows] == labels[some, None]
            right = right & (piece.ids[rows] != ids[some, None]) if same else ~right
            parts = [found]
            for w in range(lows.shape[1]):
                good = right & (scores >= floors[some, w, None]) & (scores <= highs[some, w, None])
                if good.shape[1] > 4 * keep:
                    ranked = np.where(good, scores, -ANY)
                    good &= ranked >= np.partition(ranked, -keep, axis=1)[:, -keep, None]
                at, row = np.nonzero(good)
                parts.append((some[at], np.full(len(at), w), scores[at, row], piece.ids[rows][row]))
            if sum(len(p[0]) for p in parts[1:]):
                found, place = best(*(np.concatenate(c) for c in zip(*parts)), keep)
                full = place == keep - 1
                floors[found[0][full], found[1][full]] = found[2][full]
    return found


def best(anchor, window, score, ids, keep: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The first ``keep`` entries of each (anchor, window), and their places from 0."""
    order = np.lexsort((ids, -score, window, anchor))
    anchor, window, score, ids = anchor[order], window[order], score[order], ids[order]
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(window, prepend=-1) != 0))
    place = np.arange(len(anchor)) - np.repeat(new, np.diff(np.append(new, len(anchor))))
    stays = place < keep
    return (anchor[stays], window[stays], score[stays], ids[stays]), place[stays]


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def searched(width: int, keep: int, same: bool):
    """A function for mapInArrow over (group, kind): first a piece's rows, then the anchors that go through it.

    Only the rows of one piece are held; anchors pass by in batches.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at, piece = None, None
        for batch in batches:
            keys = np.stack([numbers(batch, c) for c in ("g1", "g2", "kind")], axis=1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), len(keys)] if len(keys) else []
            for s, e in zip(edges, edges[1:]):
                part = batch.slice(s, e - s)
                group, kind = tuple(keys[s, :2]), keys[s, 2]
                if group != at:
                    at, held, piece = group, [], None
                if kind == 0:
                    held.append(part)
                    continue
                if piece is None:
                    if not held:
                        continue
                    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    vectors, angles = matrix(rows.column("v"), width, np.float64), matrix(rows.column("angles"), DIRECTIONS, np.float64)
                    piece, held = Piece.of(vectors, numbers(rows, "id"), numbers(rows, "label"), numbers(rows, "norm"), angles), []
                for k in range(0, len(part), ANCHORS):
                    some = part.slice(k, ANCHORS)
                    windows = len(some.column("lows")[0])
                    anchor, window, score, ids = search(
                        piece,
                        matrix(some.column("v"), width, np.float64),
                        numbers(some, "id"),
                        numbers(some, "label"),
                        numbers(some, "norm"),
                        matrix(some.column("angles"), DIRECTIONS, np.float64),
                        matrix(some.column("lows"), windows, np.int64),
                        matrix(some.column("highs"), windows, np.int64),
                        keep,
                        same,
                    )
                    columns = [numbers(some, "row")[anchor], window + 1, ids, score]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["row", "window", "id", "score"])

    return frugal(run)


def whole_vectors(vectors: DataFrame, anchor: Column, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """Rows that take part: ``id`` (the largest long for null), ``label``, scaled components ``v`` and whether it is an ``anchor``."""

    def real(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= MOST / scale)

    taken = vectors.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(vector_col, real))
    return taken.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.transform(vector_col, lambda x: F.floor(scale * x.cast("double")).cast("int")).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )


def with_angles(rows: DataFrame, width: int) -> DataFrame:
    """Norms and angles to the reference directions, a bounded sample: rows with the least hashes of their ids."""
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(DIRECTIONS).select("v").collect()
    directions = np.eye(DIRECTIONS, width)
    for k, r in enumerate(drawn):
        vector = np.zeros(width)
        vector[: len(r["v"])] = r["v"]
        if vector.any():
            directions[k] = vector / np.linalg.norm(vector)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("v"), width, np.float64)
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            angles = angles_to(vectors, norms, directions)
            flat = pa.ListArray.from_arrays(np.arange(0, angles.size + 1, DIRECTIONS, dtype=np.int32), pa.array(angles.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms), flat], names=[*batch.schema.names, "norm", "angles"])

    return rows.mapInArrow(frugal(measure), "row long, id long, label long, v array<int>, anchor boolean, norm double, angles array<double>")


def through(rows: DataFrame, anchors: DataFrame, pieces: int, width: int, keep: int, same: bool) -> DataFrame:
    """What each anchor finds in each piece it visits; rows and anchors carry their piece (g1, g2)."""
    columns = ["g1", "g2", "kind", "row", "id", "label", "v", "norm", "angles", "lows", "highs"]
    none = F.lit(None).cast("array<long>")
    both = rows.withColumns({"kind": F.lit(0), "lows": none, "highs": none}).select(columns)
    both = both.unionByName(anchors.withColumn("kind", F.lit(1)).select(columns))
    dealt = both.repartition(max(1, min(pieces, 20_000)), "g1", "g2").sortWithinPartitions("g1", "g2", "kind")
    return dealt.mapInArrow(searched(width, keep, same), "row long, window long, id long, score long")


def first_ones(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The best ``keep`` of what the pieces gave for each key, with their places from 1."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(``scale`` * x); a score is the integer inner product with the anchor.
    Anchors are the rows of ``vectors`` that satisfy ``anchor``, a stated set of queries: all rows
    are searched for each. Its positives are the ``positives`` best other rows of its label, its
    negatives for a positive the ``negatives`` best rows of other labels whose score lies between
    ``low_percent`` and ``high_percent`` of the positive's. Higher scores come first, ties by the
    smaller id. A positive without such a row gives nothing, as does a negative positive score,
    whose limits cross.

    The table is cut into pieces of bounded bytes, for positives by label and hash, for negatives
    by hash, so that a label or a vector on a third of all rows is spread like any other. Anchors
    are sent through the pieces in batches; one piece and one batch are held at a time. In a piece
    an anchor's wanted scores tighten as it finds rows, and angles to the reference directions
    decide exactly which rows can still matter; a task gives at most a window's few best rows.
    Every anchor meets every piece: work is rows times anchors, and a table much larger than this
    one needs a smaller share of anchors.

    Rows with a null label, a null vector, or any component that is null, not finite or beyond
    2^20 after scaling take no part. Shorter vectors count as ending in zeros, empty ones as zeros.
    A null id is no anchor unless the condition says so, and comes last in ties. Rows with the
    anchor's id are not other rows; otherwise rows that share an id, repeated rows too, are rows of
    their own, and so are repeated anchors. Empty tables, and tables without anchors, give no
    rows. Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    with_package(spark)
    taken = whole_vectors(vectors, anchor, id_col, vector_col, label_col, scale)
    width = max(1, taken.agg(F.max(F.size("v"))).first()[0] or 1)
    numbered = taken.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "label", "v", "anchor")
    rows = stage(with_angles(numbered, width), "vectors")
    per = max(LEAST_ROWS, PIECE_BYTES // (8 * width))
    spread = spark.sparkContext.defaultParallelism

    def cut(n: Column) -> Column:
        """Pieces of n rows: of bounded bytes, and of fewer rows while cores would stand idle."""
        return F.greatest(F.ceil(n / per), F.least(F.ceil(n / LEAST_ROWS), F.lit(spread)))

    sizes = stage(rows.groupBy("label").agg(cut(F.count("*")).alias("pieces")), "labels")
    of_labels = sizes.agg(F.sum("pieces")).first()[0] or 0
    pieces = rows.agg(cut(F.count("*"))).first()[0]
    anchors = rows.where("anchor")
    mixed = F.xxhash64("row")

    known = rows.join(small_side(sizes), "label")
    by_label = known.withColumns({"g1": F.col("label"), "g2": F.pmod(mixed, F.col("pieces"))})
    all_scores = {"lows": F.array(F.lit(-ANY)), "highs": F.array(F.lit(ANY))}
    visits = known.where("anchor").withColumns({"g1": F.col("label"), "g2": F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)), **all_scores})
    near = first_ones(through(by_label, visits, of_labels, width, positives, True), ["row"], positives)
    owners = anchors.select("row", F.col("id").alias("anchor_id"))
    near = stage(near.select("row", F.col("place").cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    limits = near.selectExpr("row", "window", f"positive_score * {low_percent} as a", f"positive_score * {high_percent} as b")
    limits = limits.selectExpr("row", "window", "(a + pmod(-a, 100)) div 100 as low", "(b - pmod(b, 100)) div 100 as high")
    wanted = limits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("w"))

    def filled(name: str, closed: int) -> Column:
        return F.concat(F.col(f"w.{name}"), F.array_repeat(F.lit(closed).cast("long"), positives - F.size("w")))

    wanted = wanted.select("row", filled("low", 1).alias("lows"), filled("high", 0).alias("highs"))
    anywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))) if pieces else F.lit(0).cast("long")
    visits = anchors.join(wanted, "row").withColumns({"g1": F.lit(0).cast("long"), "g2": anywhere})
    dealt = rows.withColumns({"g1": F.lit(0).cast("long"), "g2": F.pmod(mixed, F.lit(max(1, pieces)))})
    hard = first_ones(through(dealt, visits, pieces, width, negatives, False), ["row", "window"], negatives)
    out = hard.join(near, ["row", "window"]).join(owners, "row")

    def known_id(name: str) -> Column:
        return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)

    out = out.withColumnsRenamed({"place": "rank", "id": "negative_id", "score": "negative_score"})
    return out.select(known_id("anchor_id"), known_id("positive_id"), "rank", known_id("negative_id"), "positive_score", "negative_score")
