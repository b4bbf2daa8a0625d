"""Lines that stand in many documents stay in one of them, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import lower_ascii, small_side
from marlake.session import stage

MIN_CHARS = 20
MIN_DOCS = 3
BLANK_CHARS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without ASCII blanks at its ends and with A to Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANK_CHARS)))


def hashed_key(key: Column, at: Column) -> Column:
    """The 128 bits that stand for a key, and the line's place."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), at.alias("pos"))


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_lines`` (before), ``n_dropped`` and ``clean_text``.

    A text is split at line feeds. A line's key is the line without ASCII blanks at its ends and
    with A to Z in lower case. A key of at least ``min_chars`` code points that ``min_docs``
    different documents hold keeps its lines only in the largest id among them, all of them there;
    elsewhere all its lines go. What stays keeps its order and its own bytes.

    Each long line is one narrow row (two 64-bit hashes, which stand for the key, and its place);
    documents per key are counted in two steps, by (key, document) and then by key, so that a key
    in a third of all documents is spread over many tasks and arrives as one partial count per
    task. Only lines that go are shuffled once more, and gathered per document row.

    Null text counts as one empty line, as does empty text; both give an empty ``clean_text``. A
    text of any length is one row, cut and put together by array functions of linear cost. Rows
    that share an id are one document: they count once, and all of them keep the lines of a key
    whose largest id is theirs. Rows without an id add nothing to a count and lose every line that
    is dropped anywhere. Repeated rows each get a row. An empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select("doc_id", "text", F.split("text", "\n", -1).alias("lines"))
    keys = F.transform("lines", lambda x, i: F.struct(line_key(x).alias("key"), i.alias("pos")))
    long_ones = F.filter(keys, lambda k: F.length(k["key"]) >= min_chars)
    base = stage(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text",
            F.size("lines").cast("long").alias("n_lines"),
            F.transform(long_ones, lambda k: hashed_key(k["key"], k["pos"])).alias("keys"),
        ),
        "line-keys",
    )
    each = base.select("row", "doc_id", F.explode("keys").alias("k")).select("row", "doc_id", "k.*")
    held = each.where(F.col("doc_id").isNotNull()).groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    shared = held.groupBy("h1", "h2").agg(F.count("one").alias("docs"), F.max("doc_id").alias("keeper")).where(F.col("docs") >= min_docs)
    shared = stage(shared.drop("docs"), "shared-lines")
    gone = each.join(small_side(shared), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    places = gone.groupBy("row").agg(F.collect_list("pos").alias("gone"))
    # A column of its own: inside the lambda the text would be cut again for every line.
    cut = base.drop("keys").join(places, "row", "left").withColumn("lines", F.split("text", "\n", -1))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stays, lambda i: F.get("lines", i)), "\n")
    return cut.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("clean_text"),
    )
