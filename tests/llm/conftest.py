import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, digest string, run string"
LONG = " ".join(f"w{i}" for i in range(3000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(120))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "plain words here", "en", "a"), (2, "plain words here", "en", "a"), (2, "plain words here", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, LONG, "en", "a"), (6, LONG + " more", "de", "a"),
        (None, "plain words here", "en", None), (7, BASE, "en", "b"), (8, BASE.replace("alpha5 ", "other "), "en", "b"),
        (9, "  \t ", None, "b"), (10, "PASSWORD = 'abc123xyz' ▁ ü", "es", "c"),
    ]
    return spark.createDataFrame([(i, t, la, s, None, 1, "x", "y") for i, t, la, s in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)
