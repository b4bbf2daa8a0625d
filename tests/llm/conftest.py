import random

import pytest

CLASHING = ["_row", "_id", "_t", "_text", "value", "node", "n", "count", "kept", "part", "seq", "row", "text_hash", "label", "_rank", "pii_found"]


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(n))


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def awkward_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and blank texts, ties, repeated rows, a very long text."""
    rng = random.Random(5)
    rows = [(i, prose(rng, 20 + 13 * i) + "\nSame line 1 here", "en", f"s{i % 3}", i) for i in range(20)]
    rows += [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \t\n\r\x0b\x0c ", "en", None, 7), (103, "one two", "de", "s1", 7)]
    rows += [(104, "One TWO", "de", "s1", 7), (105, rows[3][1], "en", "s0", 3), (106, rows[3][1], "en", "s1", 3), (None, rows[4][1], "fr", "s2", 1)]
    rows += [(None, None, None, None, None), (107, "é ü ß x Ünï ÉÉ 日本語 #*$%&|<>", "fr", "s1", 9), (108, prose(rng, 60_000, 50_000), "en", "s0", 1)]
    rows += [rows[7], rows[7], (109, "a b c a b c a b c\na b c a b c a b c", "en", "s0", 5)]
    return rows


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(awkward_rows, DOCS).repartition(3).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def direct(vocabulary):
    """Ids of a text by the whole tokenizer."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids
