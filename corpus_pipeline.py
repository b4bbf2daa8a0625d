"""From raw documents to packed training sequences.

Each stage works on what its predecessor kept; ``run`` writes every stage's result as Parquet and
reads it again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlake.llm import decontamination, importance, near_dup, packing, pii
from marlake.llm.common import small_side, without
from marlake.llm.queries import KEY, VOCABULARY
from marlake.session import configure, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps; labels come from the table beside the documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without(docs, importance.resample(docs, labels), ~F.col("kept")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the smallest id, null last, then the smallest text hash; of equal rows, one.

    Rows without an id, and texts that share one, are judged by their texts like all others; texts without a word group by their id.
    """
    found = near_dup.near_duplicates(docs, percent=PERCENT, with_rows=True)
    wordless = F.when(F.col("label").isNull(), F.col("doc_id"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("_k")
    keys = found.groupBy("label", wordless.alias("_own")).agg(least)
    keys = stage(keys.select(F.col("_k.doc_id").alias("_id"), F.col("_k.text_hash").alias("_hash")), "kept")
    counts = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("_rows"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    keys = stage(counts.join(small_side(keys), same).select("_id", "_hash", "_rows"), "kept")
    mine = F.xxhash64(F.col("text").cast("string"))
    kept = docs.select(COLUMNS).join(small_side(keys), F.col("doc_id").eqNullSafe(F.col("_id")) & (mine == F.col("_hash")))
    again = kept.where("_rows > 1").dropDuplicates(["_id", "_hash"])
    return kept.where("_rows = 1").select(COLUMNS).union(again.select(COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, decontamination.find_leaks(docs, benchmark), F.col("contaminated")).select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; ``n_chars`` follows the text."""
    out = pii.replace_personal_data(docs, KEY)
    return out.withColumn("n_chars", F.when(F.col("pii_found") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 ids."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("personal data", personal_data),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the pieces of the last one."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
