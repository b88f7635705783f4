import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, fingerprint int, score string, tokens string, block int, copies string, tail int, bucket int"


def table(spark, rows):
    """rows of (doc_id, text, source); the further columns clash with names that operators use."""
    return spark.createDataFrame([(i, t, "en", s, None, "x", 1, "y", "z", 2, "c", 3, 4) for i, t, s in rows], SCHEMA)


LONG = " ".join(f"word{i % 97} Émile, {i}." for i in range(3000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old mill by the river.", "a"), (2, "the QUICK brown fox jumps over the lazy dog near the old mill by the river.", "a"),
    (3, None, "b"), (4, "", "b"), (5, "   \n\t", None), (6, LONG, "a"), (7, LONG, "b"), (8, "x" * 20000, "a"), (9, "naïve İstanbul ΣΑΣ ﬁ 漢字 🎉 <|endoftext|> ok", "c"), (10, "a", None),
    (11, "same", "a"), (11, "same", "a"), (12, "Same", "a"), (13, "one two three four five six seven eight nine ten eleven twelve", "a"), (14, "one two three four five six seven eight nine ten eleven twelve!", "a"),
    (None, "no id", "c"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, ROWS)


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])
