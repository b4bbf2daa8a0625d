import brute
import pytest

from marlake.llm import line_dedup

SCHEMA = "doc_id long, text string"


def run(df, **settings):
    out = line_dedup.line_dedup(df, **settings)
    return sorted((tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "clean_text").collect()), key=repr)


@pytest.mark.parametrize("min_chars,min_docs", [(20, 3), (5, 2), (1, 1)])
def test_equals_the_plain_version(awkward, awkward_rows, min_chars, min_docs):
    want = brute.line_dedup([(r[0], r[1]) for r in awkward_rows], min_chars, min_docs)
    assert run(awkward, min_chars=min_chars, min_docs=min_docs) == sorted(want, key=repr)


def test_only_the_largest_document_keeps_a_shared_line(spark):
    line = "A line that many documents hold"
    rows = [(1, f"{line}\nown one\n  {line.upper()}\t\r"), (2, f"x\n{line}"), (3, f"{line}\n\n{line} "), (4, "short line\nshort line"), (5, None), (6, "")]
    got = {r[0]: r[1:] for r in run(spark.createDataFrame(rows, SCHEMA))}
    assert got[1] == (3, 2, "own one") and got[2] == (2, 1, "x")
    assert got[3] == (3, 0, rows[2][1]) and got[4] == (2, 0, rows[3][1])
    assert got[5] == got[6] == (1, 0, "")


def test_length_counts_code_points_and_only_ascii_is_lowered(spark):
    nineteen, twenty = "É" * 19, "É" * 20
    rows = [(i, f"{nineteen}\n{twenty}\n{twenty.lower() if i == 3 else twenty}\n {twenty}") for i in (1, 2, 3, 4)]
    got = {r[0]: r[2] for r in run(spark.createDataFrame(rows, SCHEMA))}
    assert got == {1: 3, 2: 3, 3: 2, 4: 0}


def test_rows_that_share_an_id_are_one_document(spark):
    line = "the very same long line here"
    rows = [(7, line), (7, line), (8, line), (None, line), (None, f"{line}\nrest")]
    assert {r[2] for r in run(spark.createDataFrame(rows, SCHEMA))} == {0}
    got = run(spark.createDataFrame([*rows, (9, line), (9, f"{line}\n{line}")], SCHEMA))
    want = [(7, 1, 1, ""), (7, 1, 1, ""), (8, 1, 1, ""), (9, 1, 0, line), (9, 2, 0, f"{line}\n{line}"), (None, 1, 1, ""), (None, 2, 1, "rest")]
    assert got == sorted(want, key=repr)


def test_empty_table_and_no_python(empty, awkward):
    assert line_dedup.line_dedup(empty).count() == 0
    text = line_dedup.line_dedup(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
