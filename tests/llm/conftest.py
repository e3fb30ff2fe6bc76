import pytest

ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 44),
    (2, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 44),
    (3, None, "en", "a", None),
    (4, "", None, "b", 0),
    (5, "  \n\t ", "de", None, 5),
    (None, "one two three four five six seven", "de", None, 33),
    (None, "one two three four five six seven", "de", None, 33),
    (7, "wort " * 30_000, "de", "b", 150_000),
    (8, "short", "fr", "b", 5),
    (8, "short", "fr", "b", 5),
    (9, "ein anderes Wort und noch eins dazu", "de", "c", 35),
    (9, "another text under an id that is taken", "en", "c", 38),
    (10, "😀 é ß 中文 हिन्दी", None, "", 15),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: rows["doc_id"] for c in ("key", "size", "rank", "id", "node", "row", "h", "shard", "score", "removed", "toxic")}
    return rows.withColumns(extra)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
