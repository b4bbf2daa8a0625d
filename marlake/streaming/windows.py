"""Which blocks of time are due, from checkpoints and bounds kept as rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import batch_window_id

HOURS = 6


def pending_windows(states: DataFrame, hours: int = HOURS) -> DataFrame:
    """Complete blocks between ``last_processed_at`` and ``upper_bound`` of each pipeline, in order.

    The first block starts at the next block boundary at or after the checkpoint, so a checkpoint
    just before midnight never brings back hours that were already loaded.
    """
    size = F.lit(hours * 3600 * 1_000_000)
    start = F.timestamp_micros((F.ceil(F.unix_micros("last_processed_at") / size) * size).cast("bigint"))
    last = F.timestamp_micros((F.floor(F.unix_micros("upper_bound") / size) * size).cast("bigint"))
    step = F.expr(f"interval {hours} hours")
    due = states.withColumns({"_from": start, "_to": last - step}).where("_from <= _to")
    return due.select(
        "pipeline_name", F.explode(F.sequence("_from", "_to", step)).alias("window_start")
    ).select(
        "pipeline_name",
        "window_start",
        (F.col("window_start") + step).alias("window_end"),
        batch_window_id("window_start", hours).alias("batch_id"),
    )


def bounded_by_upstream(downstream: DataFrame, upstream: DataFrame) -> DataFrame:
    """Attach the cursor of the upstream pipeline as the bound a pipeline must not pass."""
    cursor = upstream.agg(F.max("last_processed_at").alias("c")).scalar()
    return downstream.withColumn("upper_bound", cursor)


def windows_between(last: datetime, bound: datetime, hours: int = HOURS) -> list[tuple[datetime, datetime, str]]:
    """Driver-side form of :func:`pending_windows` for one pipeline."""
    size = timedelta(hours=hours)
    midnight = datetime(last.year, last.month, last.day, tzinfo=last.tzinfo)
    start = midnight + size * -(-(last - midnight) // size)
    found = []
    while start + size <= bound:
        found.append((start, start + size, f"live-{start:%Y-%m-%d}-{start.hour:02d}-{start.hour + hours:02d}"))
        start += size
    return found


def with_batch_window(events: DataFrame, ts: str, hours: int = HOURS) -> DataFrame:
    """Tumbling block of each row and its batch id."""
    w = F.window(F.col(ts), f"{hours} hours")
    return events.withColumn("_w", w).select(
        *events.columns,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        batch_window_id("_w.start", hours).alias("batch_id"),
    )


def pending_days(days: DataFrame, loaded: DataFrame, first: date | str) -> DataFrame:
    """Days from ``first`` on that have no loaded batch yet, oldest first."""
    return (
        days.where(F.col("day") >= F.lit(first).cast("date"))
        .withColumn("batch_id", F.concat(F.lit("backfill-"), F.col("day").cast("string")))
        .join(loaded.select("batch_id").distinct(), "batch_id", "left_anti")
        .orderBy("day")
    )
