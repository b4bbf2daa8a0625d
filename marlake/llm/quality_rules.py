"""Rules on whole texts and on lines that many documents of a host share, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.llm.common import BLANKS, words
from marlake.session import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 20
MAX_PER_MILLE = 0
MIN_LEFT_PERCENT = 50
LETTERS_PER_DIGIT = 4
HAS_WORD = r"[^\x20\x09-\x0D]"


def squeezed(line: Column) -> Column:
    """A line in lower case, with blanks squeezed."""
    return F.lower(F.btrim(F.regexp_replace(line, BLANKS, " ")))


def normalised(line: Column) -> Column:
    """A squeezed line; with every digit as 0 if it has ``LETTERS_PER_DIGIT`` times as many letters and signs, as a dated notice has."""
    line = squeezed(line)
    others = F.length(F.translate(line, "0123456789 ", ""))
    digits = F.length(line) - F.length(F.translate(line, "0123456789", ""))
    return F.when(others >= LETTERS_PER_DIGIT * digits, F.translate(line, "123456789", "000000000")).otherwise(line)


def count_words(line: Column) -> Column:
    """Words of a line that has at least one."""
    return F.size(F.split(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), BLANKS, -1))


def repeated_words(w: str) -> list[tuple[str, Column]]:
    """Steps of the count of words that lie in a 3-word window found twice or more in the array column ``w``.

    Windows are hashed and sorted with their place; a window is repeated if a neighbour in that
    order has its hash. Each repeated window then covers the words that the one before it leaves.
    """
    at = F.col(w)
    n = F.size(at)
    window = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(at[i], at[i + 1], at[i + 2]))
    hashes = F.col("_h")
    places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    p = F.col("_p")

    def twin(x: Column, k: Column) -> Column:
        before = F.get(p, k - 1)["h"]
        after = F.get(p, k + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter(p, twin), lambda x: x["i"]))
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        starts,
        state,
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).cast("long").alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return [
        ("_h", F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>"))),
        ("_p", F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), places)),
        ("n_repeat_words", F.when(p.isNull(), F.lit(0).cast("long")).otherwise(covered)),
    ]


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_docs: int = MAX_DOCS,
    max_per_mille: int = MAX_PER_MILLE,
    min_left_percent: int = MIN_LEFT_PERCENT,
    with_text: bool = True,
) -> DataFrame:
    """One row per document row with its counts, its removed lines and the verdict ``kept``.

    A normalised line is removed from a host's documents if more than ``max_docs`` of the host's
    documents (and more than ``max_per_mille`` of a thousand of them) hold it in one form each: a
    document with several lines that differ by their digits only, as rows of a table do, does not
    count. The limit does not grow with the host unless ``max_per_mille`` is set. A document fails
    the base rules with fewer than ``min_words`` words or with more than ``max_repeat_percent`` of
    its words in repeated 3-word windows; it is depleted if fewer than ``min_left_percent`` of its
    words stand in lines that stay. ``kept`` is neither.

    ``n_lines`` counts lines with a word, ``n_removed_lines`` and ``n_removed_words`` what goes;
    with ``with_text`` the column ``clean_text`` has the lines that stay (lines without a word
    included). Each line is one narrow row (two 64-bit hashes), partially counted before it is shuffled;
    a line that a third of the rows hold is split by the adaptive join.

    Windows and lines are compared by hashes (64 bits, and 128 for lines across documents). A text
    of any length is one row of arrays, counted whole. There are no ties: a line is removed
    everywhere in its host, also where it is repeated inside one document.

    Null text has no words and fails, as does empty text. A null host is a host of its own. A
    document is counted by its id: repeated rows with one id count once in a line's frequency and each get a
    row; rows with a null id add nothing to it. An empty table gives no rows. Other columns are
    ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(F.col("_t"), "\n", -1), lambda x: x.rlike(HAS_WORD))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit("-")).alias("_host"),
        text.alias("_t"),
    ).withColumns({"_w": words(F.col("_t")), "_l": lines})
    for name, column in repeated_words("_w"):
        rows = rows.withColumn(name, column)
    hashed = F.transform(
        F.col("_l"),
        lambda x: F.struct(
            F.xxhash64(normalised(x)).alias("h1"), F.xxhash64(F.lit(1), normalised(x)).alias("h2"), F.xxhash64(squeezed(x)).alias("form"), count_words(x).alias("words")
        ),
    )
    base = stage(
        rows.select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            "_host",
            F.size("_w").cast("long").alias("n_words"),
            F.length(F.regexp_replace("_t", BLANKS, "")).cast("long").alias("word_chars"),
            (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            "n_repeat_words",
            F.size("_l").cast("long").alias("n_lines"),
            hashed.alias("_lines"),
            *(["_t"] if with_text else []),
        ),
        "lines",
    )
    each = base.select("_row", "doc_id", "_host", F.explode("_lines").alias("l")).select("_row", "doc_id", "_host", "l.*")
    held = each.where(F.col("doc_id").isNotNull()).groupBy("_host", "h1", "h2", "doc_id").agg((F.min("form") == F.max("form")).alias("_one_form"))
    frequent = held.groupBy("_host", "h1", "h2").agg(F.count_if("_one_form").alias("_docs")).where(F.col("_docs") > max_docs)
    hosts = base.groupBy("_host").agg(F.countDistinct("doc_id").alias("_of"))
    removed = stage(
        frequent.join(hosts, "_host").where(F.col("_docs") * 1000 > F.col("_of") * max_per_mille).select("_host", "h1", "h2"), "frequent"
    )
    lost = (
        each.drop("form").join(removed, ["_host", "h1", "h2"])
        .groupBy("_row")
        .agg(F.count("*").alias("n_removed_lines"), F.sum("words").alias("n_removed_words"))
    )
    out = base.drop("_lines", "_t").join(lost, "_row", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_removed_lines", "n_removed_words")}
    )
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    left = F.col("n_words") - F.col("n_removed_words")
    out = out.withColumn("base_failed", failed).withColumn("depleted", left * 100 < F.col("n_words") * min_left_percent)
    out = out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    if with_text:
        out = out.join(clean_text(base, removed), "_row", "left").withColumn("clean_text", F.coalesce("clean_text", F.lit("")))
    return out.drop("_row", "_host")


def clean_text(base: DataFrame, removed: DataFrame) -> DataFrame:
    """``_row`` and the text without the removed lines, put together again in their order."""
    line = F.col("line")
    cut = base.select("_row", "_host", F.posexplode(F.split("_t", "\n", -1)).alias("pos", "line")).withColumns(
        {"h1": F.xxhash64(normalised(line)), "h2": F.xxhash64(F.lit(1), normalised(line))}
    )
    stays = cut.join(removed, ["_host", "h1", "h2"], "left_anti")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return stays.groupBy("_row").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("clean_text"))
