"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlake.llm import decontamination, hard_negatives, importance, line_dedup, near_dup, packing, periodic_runs, pii, quality_rules, sharding, token_files, toxicity, warc
from marlake.llm.sql import SQL
from marlake.session import configure, scratch_path

VOCABULARY = "word_bpe_49k.json"
VOCABULARY_IDS = 49_408
SHARDS = 40
KEY = "marlake-surrogates"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REFERENCE_SQL: dict[str, str] = dict(SQL)


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdicts of the quality rules for every document."""
    out = quality_rules.quality_rules(table(spark, folder, "documents"), with_text=False)
    more = ["n_lines", "n_removed_lines", "n_removed_words", "depleted"]
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *more)


@query
def op2_online_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), with_ids=False)


@query
def op3_content_addressed_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's record, rebuilt from the archive and parsed."""
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.read_back(spark, path)


@query
def op4_bottom_k_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Component and verdict of every document."""
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@query
def op5_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight of every document, whether it is above the floor (``kept``), and whether the draw of half of those takes it (``drawn``)."""
    found = importance.resample(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=0.5)
    return found.withColumnsRenamed({"kept": "drawn", "above_floor": "kept"})


@query
def op6_bit_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place and checksum, as read back from the packed files."""
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), path, public_tokenizers.path(VOCABULARY), VOCABULARY_IDS)
    return token_files.documents(token_files.read_blocks(spark, path), with_ids=False)


@query
def op7_naive_bayes_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query
def op8_prefix_sum_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document."""
    out = sharding.assign(table(spark, folder, "documents"), SHARDS)
    return out.withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op9_latent_retrieval(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in every document."""
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with surrogates for its personal data."""
    return pii.replace_personal_data(table(spark, folder, "documents"), KEY)


@query
def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Line counts and the checksum of what stays of every document."""
    out = line_dedup.line_dedup(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("clean_text", 256).alias("kept_sha256"))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of every document, the longest one, and the checksums of all and of what stays."""
    out = periodic_runs.periodic_runs(periodic_runs.planted(table(spark, folder, "documents")))
    best = periodic_runs.longest(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    out = out.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), line.alias("lines"), "collapsed")
    length = -F.col("best.less")
    return out.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join("lines", "\n"), F.when(F.size("lines") > 0, F.lit("\n")).otherwise(F.lit(""))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; each seventh vector's label is moved first."""
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
