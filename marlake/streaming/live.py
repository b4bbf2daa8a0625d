"""Structured Streaming form of the six-hour cadence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marlake.functions.expr import batch_window_id
from marlake.session import stage
from marlake.sources.lake import BATCH, Lake
from marlake.streaming.incremental import upsert_batches

WINDOW = "6 hours"
STREAM_BATCH = "stream_batch"


def read_files(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def write_window_deltas(events: DataFrame, ts: str, by: list[str], target: str, checkpoint: str) -> StreamingQuery:
    """Count rows per six-hour window and key of each micro-batch.

    A micro-batch owns the partitions (window, its own number), so running it again after a
    failure replaces its counts. Nothing is held in state and no row comes too late.
    """

    def load(batch: DataFrame, number: int) -> None:
        counts = (
            batch.groupBy(F.window(F.col(ts), WINDOW).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(
                F.col("w.start").alias("window_start"),
                F.col("w.end").alias("window_end"),
                *by,
                "n",
                batch_window_id("w.start").alias(BATCH),
                F.lit(number).cast("bigint").alias("stream_batch"),
            )
        )
        (
            stage(counts, "deltas")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH, "stream_batch")
            .parquet(target)
        )

    return _start(events, load, checkpoint)


def window_totals(deltas: DataFrame, by: list[str]) -> DataFrame:
    """Totals per window and key from the counts of all micro-batches."""
    return deltas.groupBy(BATCH, "window_start", "window_end", *by).agg(F.sum("n").alias("n"))


def closed_window_counts(events: DataFrame, ts: str, by: list[str], delay: str = WINDOW, watermarked: bool = False) -> DataFrame:
    """Counts of windows that can no longer change, for an append-mode sink.

    A window is handed on once, after the watermark has passed its end; the state of a window
    goes with it. ``watermarked`` says that ``events`` has its watermark already.
    """
    return (
        (events if watermarked else events.withWatermark(ts, delay))
        .groupBy(F.window(F.col(ts), WINDOW).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            batch_window_id("w.start").alias(BATCH),
            *by,
            "n",
        )
    )


def ingest(
    source: DataFrame,
    ts: str,
    lake: Lake,
    table: str,
    clean: Callable[[DataFrame], DataFrame],
    checkpoint: str,
) -> StreamingQuery:
    """Load a bronze stream into a silver table with the silver rules of the batch path.

    Each row goes to the partition of its six-hour window. A window may arrive over several
    micro-batches: its partition is merged by key, so repeated deliveries and a retried
    micro-batch leave one row per key, and a late row still finds its window.
    """

    def load(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(BATCH, batch_window_id(ts))
        upsert_batches(lake, table, clean(rows), extend=True)

    return _start(source, load, checkpoint)


def first_deliveries(events: DataFrame, ts: str, key: str, delay: str = WINDOW) -> DataFrame:
    """Each key once; state is kept for ``delay`` after a row's time, and rows behind the watermark are left out."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def append_to(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table; a micro-batch that is run again replaces what it wrote."""

    def load(batch: DataFrame, number: int) -> None:
        (
            stage(batch.withColumn(STREAM_BATCH, F.lit(number).cast("bigint")), "appended")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(STREAM_BATCH)
            .parquet(target)
        )

    return _start(rows, load, checkpoint)


def write_late_rows(events: DataFrame, ts: str, target: str, marks: str, checkpoint: str, delay: str = WINDOW) -> StreamingQuery:
    """Write the rows that arrive behind the watermark to a table of their own, by micro-batch.

    The watermark of a micro-batch is the largest time of the earlier ones less ``delay``. A stateful
    operator beside this stream judges by the watermark of the micro-batch before, so whatever it
    leaves out as late is among these rows. Each micro-batch notes its largest time under its number in
    ``marks``, so one that is run again sees the same watermark and writes the same rows.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch, "arrived")
        numbered = F.lit(number).cast("bigint").alias(STREAM_BATCH)
        overwrite = {"partitionOverwriteMode": "dynamic"}
        rows.agg(F.max(ts).alias("high")).select("high", numbered).write.mode("overwrite").options(**overwrite).partitionBy(STREAM_BATCH).parquet(marks)
        earlier = spark.read.schema(f"high timestamp, {STREAM_BATCH} bigint").parquet(marks).where(F.col(STREAM_BATCH) < number)
        mark = earlier.agg((F.max("high") - F.expr(f"interval {delay}")).alias("m")).scalar()
        late = rows.withColumn("watermark", mark).where(F.col(ts) < F.col("watermark")).withColumn(STREAM_BATCH, F.lit(number).cast("bigint"))
        late.write.mode("overwrite").options(**overwrite).partitionBy(STREAM_BATCH).parquet(target)

    return _start(events, load, checkpoint)


def _start(source: DataFrame, load, checkpoint: str) -> StreamingQuery:
    return (
        source.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
