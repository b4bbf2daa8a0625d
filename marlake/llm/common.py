"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import marlake
from marlake.session import stage

# White space between words: the ASCII blanks only. A word is a run of anything else.
BLANKS = r"[\x20\x09-\x0D]+"
SLICE_BYTES = 2 << 20
BATCH_ROWS = 2500
# A side with at most this many narrow rows is sent to every executor; a larger one is shuffled.
SMALL_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS, -1))


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and leave every other character as it is."""
    upper = "".join(map(chr, range(65, 91)))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def small_side(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Hint a broadcast if a written narrow table has few enough rows; else leave the join to shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def without(docs: DataFrame, verdicts: DataFrame, gone: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose verdict (by id and ``text_hash``) is ``gone``; nulls match nulls."""
    bad = stage(verdicts.where(gone).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "rejected")
    mine = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    same = (mine == F.col("_bad_hash")) & F.col(id_col).eqNullSafe(F.col("_bad_id"))
    return docs.join(small_side(bad), same, "left_anti")


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut a text column into (first row, rows) of about ``limit`` bytes; a longer text stands alone. Null counts as empty."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield first, column.slice(first, i - first).fill_null("")
            first, held = i, 0
        held += int(n)
    if first < len(column):
        yield first, column.slice(first).fill_null("")


def positions(df: DataFrame, order: Sequence[Column], weight: str) -> DataFrame:
    """Global place of every row in an order, from the totals of the partitions.

    Rows are range-partitioned and sorted; each task numbers its own rows and adds up ``weight``
    before them, and the result is written. Adding the totals of the earlier partitions gives

    * ``_rank``: rows before this one, ``_before``: weight before it,
    * ``_rows``, ``_total``: rows and weight of the whole table.

    Only one row per partition is ever brought together. ``weight`` must be a long without nulls.
    Rows that are equal in ``order`` stand in any order among themselves.
    """
    schema = f"{schema_of(df)}, _part int, _local long, _sum long"

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(sizes)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n, dtype=np.int64)), pa.array(ends - sizes)],
                names=[*batch.schema.names, "_part", "_local", "_sum"],
            )
            rows, total = rows + n, int(ends[-1]) if n else total

    with_package(df.sparkSession)
    placed = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(frugal(number), schema), "positions")
    totals = placed.groupBy("_part").agg(F.max("_local").alias("_n"), F.max(F.col("_sum") + F.col(weight)).alias("_w"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = stage(
        totals.select(
            "_part",
            F.coalesce(F.sum(F.col("_n") + 1).over(earlier), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_weight_before"),
            F.sum(F.col("_n") + 1).over(whole).alias("_rows"),
            F.sum("_w").over(whole).alias("_total"),
        ),
        "parts",
    )
    return (
        placed.join(small_side(parts), "_part")
        .withColumn("_rank", F.col("_rows_before") + F.col("_local"))
        .withColumn("_before", F.col("_weight_before") + F.col("_sum"))
        .drop("_part", "_local", "_sum", "_rows_before", "_weight_before")
    )


def with_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application, and bound the rows of an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_marlake_sent", None) != context.applicationId:
        root = Path(marlake.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="marlake-code-")) / "marlake_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for f in sorted(root.rglob("*.py")):
                out.write(f, f.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._marlake_sent = context.applicationId


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def frugal(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for mapInArrow that gives free memory back to the system at its end.

    Python workers live on between tasks, and share the memory of an executor with its JVM.
    """

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped
