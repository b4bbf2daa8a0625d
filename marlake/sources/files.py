"""Readers for the raw CSV files and checks on what was read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlake.operators.dedup import first_per_key
from marlake.sources.schemas import RAW_SCHEMAS


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Scan raw CSV files (header, UTF-8 with or without BOM, quoted line breaks, doubled quotes).

    Columns are found by name and cast to the declared types; a value that does not fit is an
    error, as are a line with too few or too many fields and a file whose header differs from that of the first.
    Multi-line records keep a file in one split, so large inputs should arrive as many files.
    """

    def reader():
        return spark.read.options(header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")

    header = reader().csv(path).schema  # all text, in the order of the first file
    text = reader().options(enforceSchema=False, mode="FAILFAST").schema(header).csv(path)
    wanted = StructType.fromDDL(RAW_SCHEMAS[table])
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


def tag(df: DataFrame, batch_id: str | Column, is_synthetic: bool | Column, template_date=None) -> DataFrame:
    """Add lineage columns; the template date is always a typed date, also when null."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(
        {
            "is_synthetic": as_col(is_synthetic).cast("boolean"),
            "batch_id": as_col(batch_id).cast("string"),
            "source_template_date": as_col(template_date).cast("date"),
        }
    )


def keep_first_zip(geolocation: DataFrame) -> DataFrame:
    """One sample per zip prefix: the first one in a total order."""
    rest = [c for c in geolocation.columns if c != "geolocation_zip_code_prefix"]
    return first_per_key(
        geolocation, ["geolocation_zip_code_prefix"], [F.col(c).asc_nulls_first() for c in rest]
    )


def reconcile(sources: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """Rows in the source against rows loaded, per table, in one job."""
    counted = None
    for side, frames in (("source", sources), ("loaded", loaded)):
        for name, df in frames.items():
            one = df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"
            )
            counted = one if counted is None else counted.unionByName(one)
    return (
        counted.groupBy("table_name")
        .agg(
            F.max(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
            F.max(F.when(F.col("side") == "loaded", F.col("n"))).alias("loaded_rows"),
        )
        .withColumn("matches", F.col("source_rows") == F.col("loaded_rows"))
    )
