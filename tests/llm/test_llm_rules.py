import brute
import pytest
from pyspark.sql import functions as F

from marlake.llm import quality_rules


def run(df, **settings):
    out = quality_rules.quality_rules(df, **settings)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines", "n_removed_words"]
    return sorted((tuple(r) for r in out.select(columns).collect()), key=repr)


@pytest.mark.parametrize("max_docs,per_mille,with_text", [(20, 1, True), (3, 1, False), (1, 300, False)])
def test_equals_the_plain_version(awkward, awkward_rows, max_docs, per_mille, with_text):
    rows = [(r[0], r[1], r[3]) for r in awkward_rows]
    want = brute.quality(rows, max_docs=max_docs, per_mille=per_mille)
    got = run(awkward, max_docs=max_docs, max_per_mille=per_mille, with_text=with_text)
    assert got == sorted(want, key=repr)


def test_boilerplate_goes_and_depleted_documents_are_rejected(spark):
    shared = "Read more about our 2021 privacy rules and the terms of use here"
    own = [" ".join(f"u{i}w{k}" for k in range(60)) for i in range(40)]
    rows = [(i, f"{own[i]}\n{shared.replace('2021', str(2000 + i))}", "h") for i in range(30)]
    rows += [(30, "\n".join([shared] * 6), "h"), (31, own[31], "h"), (32, f"{own[32]}\n{shared}", "other")]
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[3]["clean_text"] == own[3] and out[3]["kept"] and out[3]["n_removed_lines"] == 1
    assert out[30]["depleted"] and not out[30]["kept"]
    assert out[31]["kept"] and out[31]["n_removed_lines"] == 0
    assert out[32]["clean_text"] == rows[32][1] and out[32]["kept"]


def test_rows_of_tables_and_a_small_share_of_a_large_host(spark):
    rows = [(i, "\n".join(f"{2000 + i} amount totals of the day for shop {k}{i}" for k in range(12)), "h") for i in range(60)]
    notice = "A notice that some documents of this host hold at their end"
    rows += [(100 + i, " ".join(f"{a}{b}x" for a in "abcdefgh" for b in "stuvwxyz") + " end of " + "xyz"[i % 3] * (i + 1) + (f"\n{notice}" if i < 21 else ""), "h") for i in range(900)]
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), with_text=False).collect()}
    assert all(out[i]["n_removed_lines"] == 0 and not out[i]["depleted"] for i in range(60))
    assert out[100]["n_removed_lines"] == 1 and out[150]["n_removed_lines"] == 0


def test_empty_table_and_no_python(empty):
    out = quality_rules.quality_rules(empty)
    assert out.count() == 0
    text = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))


def test_repeated_rows_count_once_in_the_frequency(spark):
    rows = [(1, "one shared line of words", "h")] * 30
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), with_text=False)
    assert out.agg(F.sum("n_removed_lines"), F.count("*")).first() == (0, 30)
