"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Runtime settings every plan in this library relies on. They are all session-level, so a
# cluster keeps its own values for memory, partition counts and dynamic allocation.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, app: str = "marlake", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("MARLAKE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors: ``spark.checkpoint.dir`` of the session.

    A session without that setting uses its own warehouse folder, on any master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/marlake-scratch"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return the written table.

    The copy makes values that depend on physical placement (partition numbers) stable for all
    later readers, survives the loss of executors, and reports its true size to the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*builders: Callable[[], T]) -> list[T]:
    """Build several frames or models at the same time.

    For those whose building runs jobs of its own (staged tables, fits); the cluster works on up
    to eight of them instead of one after the other.
    """
    with ThreadPoolExecutor(max_workers=min(8, len(builders))) as pool:
        return list(pool.map(lambda build: build(), builders))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete one folder through the Hadoop file system API."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; none where there is no folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small text file; one that is there already is an error."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of finished jobs from the executors' disks.

    It does so when the driver finds that nothing refers to them any more, which without need of
    memory is every half hour (``spark.cleaner.periodicGC.interval``).
    """
    spark.sparkContext._jvm.System.gc()


def drop_scratch(spark: SparkSession) -> None:
    """Remove the staged tables of this application."""
    root = scratch_root(spark)
    if path_exists(spark, root):
        remove_path(spark, root)
