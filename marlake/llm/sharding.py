"""Contiguous shards of equal bytes, from global prefix sums of document sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import positions
from marlake.session import stage

OVERHEAD = 16


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> DataFrame:
    """One narrow row per document: id, ``size`` (UTF-8 bytes plus ``overhead``) and ``text_crc32``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )


def order_of(id_col: str) -> list[Column]:
    return [F.col(id_col).asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc()]


def assign(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> DataFrame:
    """Shard and slot of every document.

    Documents stand in the order of their id (null first), then checksum, then size. With B bytes
    in all, a document goes to the shard into whose share of B / n_shards bytes its middle byte
    falls, so shards are contiguous in that order and their sizes differ from the target by less
    than the largest document. Only one total per partition is brought together; texts stay where
    they are and only (id, size, checksum) is shuffled.

    Null text counts as empty (its size is the overhead). Repeated rows are documents of their own
    and get slots of their own; rows that are equal in id, text and size may swap slots. An empty
    table gives no rows; with fewer documents than shards, or a document larger than a shard's
    target, some shards stay empty. Other columns of ``docs`` are not carried.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    placed = positions(sizes(docs, id_col, text_col, overhead), order_of(id_col), "size")
    middle = (F.lit(2) * F.col("_before") + F.col("size")).cast("decimal(38,0)") * n_shards
    shard = F.floor(middle / (2 * F.col("_total"))).cast("int")
    sharded = placed.withColumn("shard", F.least(shard, F.lit(n_shards - 1)))
    first = sharded.groupBy("shard").agg(F.min("_rank").alias("_first"))  # at most n_shards rows
    return sharded.join(F.broadcast(first), "shard").select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_rank") - F.col("_first")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> DataFrame:
    """Write the documents into one folder per shard, ``path/shard=N``, and return the assignment.

    The first row of each shard (at most ``n_shards`` rows) is fetched, and each document finds
    its shard by comparing its own place in the order with these: the texts are not joined. A
    large shard is written as several files.
    """
    assigned = stage(assign(docs, n_shards, id_col, text_col, overhead), "shards")
    key = [F.col(id_col).isNotNull(), F.coalesce(F.col(id_col), F.lit(0)), F.col("text_crc32"), F.col("size")]
    firsts = assigned.withColumn("_key", F.struct(*key)).groupBy("shard").agg(F.min("_key").alias("k")).orderBy("shard").collect()
    text = F.coalesce(F.col(text_col), F.lit(""))
    mine = [F.col(id_col).isNotNull(), F.coalesce(F.col(id_col), F.lit(0)), F.crc32(F.encode(text, "UTF-8")), (F.octet_length(text) + overhead).cast("long")]
    shard = F.lit(None).cast("int")
    for row in firsts:
        after = F.lit(True)
        for value, own in zip(reversed(tuple(row["k"])), reversed(mine)):
            after = (own > F.lit(value)) | ((own == F.lit(value)) & after)
        shard = F.when(after, F.lit(row["shard"])).otherwise(shard)
    docs.withColumn("shard", shard).hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
    return assigned
