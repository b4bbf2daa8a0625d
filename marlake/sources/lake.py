"""Layered Parquet tables: batch partitions, full rebuilds, scoring tables, pipeline state.

A batch table has a small log beside it: each write adds one file with the table's schema and the
partitions it wrote, each removal one with the partitions that went. Reads take schema and
partitions from there, so that a batch is read without listing or opening the rest of the table.
Keyed tables are also cut by the hash of their first key: a key can only be in its own bucket.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from marlake.session import drop_shuffles, list_names, path_exists, read_text, remove_path, stage, write_text

BATCH = "batch_id"
BUCKET = "key_bucket"
# Folder of the rows without a batch id, as Spark names it.
NO_BATCH = "__HIVE_DEFAULT_PARTITION__"
# Characters that Spark escapes in the name of a partition folder.
ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 32)}
STATE_SCHEMA = "pipeline_name string, last_processed_at timestamp, updated_at timestamp"
VERSION_SCHEMA = "table_name string, version string, updated_at timestamp"


class Part(NamedTuple):
    """A partition: a batch, and in a keyed table a bucket of it."""

    batch: str | None
    bucket: int | None = None


def in_batches(batch_ids: Iterable[str | None]) -> Column:
    """Condition that a row lies in one of these batches; None stands for the rows without a batch id."""
    ids = list(batch_ids)
    known = F.col(BATCH).isin([b for b in ids if b is not None])
    return known | F.col(BATCH).isNull() if None in ids else known


def not_in_batches(batch_ids: Iterable[str | None]) -> Column:
    """Condition that a row lies in none of these batches; a row without a batch id lies in none but None."""
    return ~F.coalesce(in_batches(batch_ids), F.lit(False))


def batches_of(df: DataFrame) -> list[str | None]:
    """Batch ids of a frame, one short text per load, not per row; None first if there are rows without one."""
    return sorted((r[0] for r in df.select(BATCH).distinct().collect()), key=lambda b: (b is not None, b or ""))


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Bucket of a row: children of an order share its bucket, as their first key is the order's."""
    return F.pmod(F.xxhash64(keys[0]), F.lit(buckets)).cast("int")


class Lake:
    """Tables below one root folder, addressed by layer and name."""

    def __init__(self, spark: SparkSession, root: str, file_rows: int = 5_000_000, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.file_rows = file_rows
        self.buckets = buckets
        self.entries: dict[str, dict[str, dict]] = {}  # files of the logs that were read, by log and name

    # --- plain access -----------------------------------------------------------------------
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return path_exists(self.spark, self.path(layer, table))

    def read(
        self, layer: str, table: str, batch_ids: list[str | None] | None = None, buckets: Iterable[int] | None = None, parts: Iterable[Part] | None = None
    ) -> DataFrame:
        """Read a table, or only some batches, buckets or partitions of it, whose folders alone are then opened."""
        log = self.log(layer, table)
        if log is None:  # a plain table
            return self.spark.read.parquet(self.path(layer, table))
        schema, bucketed, there = log
        wanted = set(there if parts is None else parts)
        if batch_ids is not None:
            wanted = {p for p in wanted if p.batch in set(batch_ids)}
        if buckets is not None:
            wanted = {p for p in wanted if p.bucket in set(buckets)}
        folders = [self.folder(layer, table, p) for p in ordered_parts(wanted & set(there))]
        if there and len(folders) == len(there):  # one listing of the whole table
            found = self.spark.read.schema(schema).parquet(self.path(layer, table))
        elif not folders:
            found = self.spark.createDataFrame([], schema)
        else:
            found = self.spark.read.schema(schema).option("basePath", self.path(layer, table)).parquet(*folders)
        if batch_ids is not None:
            found = found.where(in_batches(batch_ids))
        return found.drop(BUCKET) if bucketed else found

    # --- the log of a batch table -----------------------------------------------------------
    def folder(self, layer: str, table: str, part: Part) -> str:
        name = NO_BATCH if part.batch is None else "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in part.batch)
        path = f"{self.path(layer, table)}/{BATCH}={name}"
        return path if part.bucket is None else f"{path}/{BUCKET}={part.bucket}"

    def log_path(self, layer: str, table: str) -> str:
        return self.path("_meta", f"log/{layer}.{table}")

    def log(self, layer: str, table: str) -> tuple[StructType, bool, list[Part]] | None:
        """Schema, whether buckets are used, and partitions as of the last entry; None for a table without a log.

        An entry is a small file that never changes, so each is opened once; nothing of the table
        itself is touched. A table that was written without a log, in batch folders, gets its first
        entry here.
        """
        path = self.log_path(layer, table)
        names = [n for n in list_names(self.spark, path) if n.endswith(".json")]
        if not names:
            return self.adopt(layer, table) if self.exists(layer, table) else None
        known = self.entries.setdefault(path, {})
        for n in names:
            if n not in known:
                known[n] = json.loads(read_text(self.spark, f"{path}/{n}"))
        there: set[Part] = set()
        for n in names:
            there |= {Part(*p) for p in known[n]["added"]}
            there -= {Part(*p) for p in known[n]["removed"]}
        last = known[names[-1]]
        return StructType.fromJson(last["schema"]), last["bucketed"], ordered_parts(there)

    def adopt(self, layer: str, table: str) -> tuple[StructType, bool, list[Part]] | None:
        found = self.spark.read.parquet(self.path(layer, table))
        if BATCH not in found.columns or not any(f"/{BATCH}=" in f for f in found.inputFiles()[:1]):
            return None
        found = self.spark.read.option("mergeSchema", "true").parquet(self.path(layer, table))
        schema = StructType([*found.drop(BATCH).schema.fields, StructField(BATCH, StringType())])
        # Batch ids stay text: with a given schema, ids such as 007 do not turn into numbers.
        found = self.spark.read.schema(schema).parquet(self.path(layer, table))
        parts = [Part(b) for b in batches_of(found)]
        self.commit(layer, table, schema, False, parts, [])
        return schema, False, parts

    def commit(self, layer: str, table: str, schema: StructType, bucketed: bool, added: Iterable[Part], removed: Iterable[Part]) -> None:
        entry = {"schema": json.loads(schema.json()), "bucketed": bucketed, "added": list(added), "removed": list(removed)}
        write_text(self.spark, f"{self.log_path(layer, table)}/{time.time_ns():020d}-{uuid.uuid4().hex}.json", json.dumps(entry))

    def parts(self, layer: str, table: str) -> list[Part]:
        log = self.log(layer, table)
        return [] if log is None else log[2]

    # --- batch-partitioned tables -----------------------------------------------------------
    def loaded_batches(self, layer: str, table: str, batch_ids: list[str]) -> list[str]:
        """Which of these batches the table already holds, from its log."""
        if not batch_ids:
            return []
        found = {p.batch for p in self.parts(layer, table)} & set(batch_ids)
        return sorted(found, key=lambda b: (b is not None, b or ""))

    def write_batches(
        self, layer: str, table: str, df: DataFrame, keys: list[str] | None = None, replace: Iterable[Part] = (), settled: bool = False
    ) -> list[Part]:
        """Write whole batches; a batch written again replaces its own partition. Returns the partitions written.

        keys    -- of a keyed table: batches are cut into buckets, and what is replaced is one bucket of a batch
        replace -- partitions that this write stands for as well; those without new rows are removed
        settled -- each task has enough rows for every partition it holds: they are written as they lie

        Columns new to the table are added to it, older files read them as null; a column that
        changes its type is an error. An empty frame leaves the table as it is. Rebalancing puts
        small batches into one file each and splits a large batch over several writers; settled rows
        do not cross the wire again for it. The partitions are observed on the way, without another
        pass over the rows. The frame may read the partitions it replaces: they go when all is written.
        """
        log = self.log(layer, table)
        if log and log[2] and log[1] != bool(keys):
            raise ValueError(f"{layer}.{table} is stored {'with' if log[1] else 'without'} buckets")
        if keys:
            df = df.drop(BUCKET).withColumn(BUCKET, bucket_of(keys, self.buckets))
        names = [BATCH, BUCKET] if keys else [BATCH]
        seen = Observation()
        part = F.struct(BATCH, F.col(BUCKET) if keys else F.lit(None).cast("int").alias(BUCKET))
        rows = df.withColumn(BATCH, F.col(BATCH).cast("string")).observe(seen, F.collect_set(part).alias("parts"))
        schema = merged_schema(log[0] if log else None, rows.schema, names)
        (
            (rows if settled else rows.hint("rebalance", *names))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", self.file_rows)
            .option("compression", "zstd")
            .partitionBy(*names)
            .parquet(self.path(layer, table))
        )
        drop_shuffles(self.spark)
        written = observed(seen)
        stale = set(replace) - set(written)
        if written or stale:
            self.commit(layer, table, schema, bool(keys), ordered_parts(written), ordered_parts(stale))
            for p in ordered_parts(stale):
                remove_path(self.spark, self.folder(layer, table, p))
        elif log is None:
            remove_path(self.spark, self.path(layer, table))
        return ordered_parts(written)

    def append_new_batch(self, layer: str, table: str, df: DataFrame, batch_id: str) -> bool:
        """Load one batch unless the table already has it. Returns whether rows were written."""
        if self.loaded_batches(layer, table, [batch_id]) or df.isEmpty():
            return False
        return bool(self.write_batches(layer, table, df.withColumn(BATCH, F.lit(batch_id))))

    def remove_parts(self, layer: str, table: str, parts: Iterable[Part]) -> None:
        """Take partitions out of the table: first out of its log, then off the disk."""
        log = self.log(layer, table)
        gone = ordered_parts(set(parts) & set(log[2] if log else []))
        if gone:
            self.commit(layer, table, log[0], log[1], [], gone)
        for p in gone:
            remove_path(self.spark, self.folder(layer, table, p))

    def remove_batches(self, layer: str, table: str, batch_ids: Iterable[str | None]) -> None:
        ids = set(batch_ids)
        if ids:
            self.remove_parts(layer, table, [p for p in self.parts(layer, table) if p.batch in ids])

    def compact_batch(self, layer: str, table: str, batch_id: str, keys: list[str] | None = None) -> None:
        """Rewrite one batch into as few files as its size asks for; its partition value does not change."""
        self.write_batches(layer, table, stage(self.read(layer, table, [batch_id]), "compact"), keys)

    # --- write-once loads -------------------------------------------------------------------
    def load_once(self, layer: str, table: str, df: DataFrame, force: bool = False) -> bool:
        """Load a raw table unless it already has rows."""
        filled = self.exists(layer, table) and not self.read(layer, table).isEmpty()
        if filled and not force:
            return False
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(layer, table))
        return True

    # --- full rebuilds ----------------------------------------------------------------------
    def publish(self, layer: str, table: str, df: DataFrame) -> str:
        """Write a new version of a table beside the old one, then make it the current one."""
        now = datetime.now(timezone.utc)
        version = now.strftime("%Y%m%dT%H%M%S%f")
        df.write.mode("errorifexists").parquet(f"{self.path(layer, table)}/{version}")
        row = self.spark.createDataFrame([(f"{layer}.{table}", version, now)], VERSION_SCHEMA)
        row.write.mode("append").parquet(self.path("_meta", "versions"))
        return version

    def version(self, layer: str, table: str) -> str | None:
        """Latest published version's name, or None where nothing has been published yet."""
        if not self.exists("_meta", "versions"):
            return None
        rows = (
            self.spark.read.schema(VERSION_SCHEMA)
            .parquet(self.path("_meta", "versions"))
            .where(F.col("table_name") == f"{layer}.{table}")
            .agg(F.max_by("version", F.struct("updated_at", "version")).alias("version"))
            .collect()
        )
        return rows[0]["version"]

    def current(self, layer: str, table: str) -> DataFrame | None:
        """Latest published version, or None where nothing has been published yet."""
        version = self.version(layer, table)
        return None if version is None else self.spark.read.parquet(f"{self.path(layer, table)}/{version}")

    def publish_scores(self, table: str, df: DataFrame, scored_at: datetime | None = None) -> bool:
        """Replace a scoring table; a run without rows keeps the table it finds."""
        scored = stage(df.withColumn("scored_at", F.lit(scored_at or datetime.now(timezone.utc))), table)
        if scored.isEmpty():
            return False
        self.publish("predictions", table, scored)
        return True

    # --- models -----------------------------------------------------------------------------
    def save_model(self, name: str, model: PipelineModel) -> None:
        """Store a fitted pipeline; the version row that makes it current is written last."""
        now = datetime.now(timezone.utc)
        version = now.strftime("%Y%m%dT%H%M%S%f")
        model.save(f"{self.path('models', name)}/{version}")
        row = self.spark.createDataFrame([(f"models.{name}", version, now)], VERSION_SCHEMA)
        row.write.mode("append").parquet(self.path("_meta", "versions"))

    def load_model(self, name: str) -> PipelineModel:
        version = self.version("models", name)
        if version is None:
            raise RuntimeError(f"model {name} has not been trained")
        return PipelineModel.load(f"{self.path('models', name)}/{version}")

    # --- pipeline state ---------------------------------------------------------------------
    def set_state(self, pipeline: str, last_processed_at: datetime, updated_at: datetime | None = None) -> None:
        row = [(pipeline, last_processed_at, updated_at or datetime.now(timezone.utc))]
        self.spark.createDataFrame(row, STATE_SCHEMA).write.mode("append").parquet(
            self.path("bronze", "pipeline_state")
        )

    def get_state(self, pipeline: str) -> datetime | None:
        if not self.exists("bronze", "pipeline_state"):
            return None
        states = self.spark.read.schema(STATE_SCHEMA).parquet(self.path("bronze", "pipeline_state"))
        rows = latest_state(states.where(F.col("pipeline_name") == pipeline)).collect()
        return rows[0]["last_processed_at"] if rows else None


def observed(seen: Observation) -> list[Part]:
    """Partitions that a write has seen; a frame that Spark knows to be empty reports nothing at all."""
    try:
        return [Part(*r) for r in seen.get["parts"]]
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return []


def ordered_parts(parts: Iterable[Part]) -> list[Part]:
    return sorted(parts, key=lambda p: (p.batch is not None, p.batch or "", -1 if p.bucket is None else p.bucket))


def merged_schema(old: StructType | None, new: StructType, partitions: list[str]) -> StructType:
    """Columns of a table and of rows written to it, partition columns last."""
    fields = [f for f in (old.fields if old else []) if f.name not in (BATCH, BUCKET)]
    known = {f.name: f.dataType for f in fields}
    for field in new.fields:
        if field.name in partitions:
            continue
        if known.setdefault(field.name, field.dataType) != field.dataType:
            raise TypeError(f"column {field.name} changes type")
        if not any(f.name == field.name for f in fields):
            fields.append(StructField(field.name, field.dataType, True))
    types = {BATCH: StringType(), BUCKET: IntegerType()}
    return StructType([*fields, *[StructField(n, types[n]) for n in partitions]])


def latest_state(states: DataFrame) -> DataFrame:
    """Latest checkpoint of every pipeline."""
    newest = F.struct("updated_at", "last_processed_at")
    return states.groupBy("pipeline_name").agg(
        F.max_by("last_processed_at", newest).alias("last_processed_at"),
        F.max("updated_at").alias("updated_at"),
    )


def add_columns_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append a batch that may bring new columns; changed types are an error."""
    for field in new.schema.fields:
        if field.name in old.columns and old.schema[field.name].dataType != field.dataType:
            raise TypeError(f"column {field.name} changes type")
    return old.unionByName(new, allowMissingColumns=True)


def synthetic_pool(customers: DataFrame) -> DataFrame:
    """All synthetic customers, who may come back."""
    return customers.where("is_synthetic").select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        "is_synthetic",
    )
