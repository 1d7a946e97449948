import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and blank texts, a very long text, copies, repeated rows and ids."""
    words = [f"w{i % 97}x{i % 13}" for i in range(30_000)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, passage, "en", "a", 1), (2, passage, "en", "a", 1), (3, f"before {passage} after", "en", "b", 1),
        (4, None, "en", "b", None), (5, "", None, None, 0), (6, " \t\n ", "de", "b", 3), (7, "one", "de", "b", 3),
        (8, "one", "de", "c", 3), (9, " ".join(words), "fr", "c", 9), (10, "Zwei  Wörter", "de", None, 2),
        (10, "Zwei  Wörter", "de", None, 2), (11, f"{passage} {passage}", "en", "a", 2), (None, passage, "en", "a", 1),
        (None, None, None, None, None), (12, "a\x00b \x1c é ü 漢字", "zz", "c", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
