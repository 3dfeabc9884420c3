import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "row_key long, digest string, size long, fp long, row long, packed string, want_id long, copies long, words string, word long, block long"
LONG = "\n".join(f"Line {i} of a long text ends here, and the next one begins." for i in range(3000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    extra = (1, "x", 2, 3, 4, "y", 5, 6, "z", 7, 8)
    none = (None,) * len(extra)
    rows = [
        (1, "Hello there, dear world of words.", "en", "a", 1), (1, "Hello there, dear world of words.", "en", "a", 1),
        (2, "Hello there,  dear world of\twords.", "en", "b", 1), (3, None, None, None, None), (4, "", "de", "a", 0),
        (None, "Hello there, dear world of words.", "en", None, 1), (5, " \n\t ", "de", None, 3), (6, LONG, "en", "a", 9), (7, LONG, "en", "b", 9),
        (8, "Ünïcödé 𝒯𝑒𝓍𝓉 mit Ä und ß.", "de", "c", 4), (8, "Another text under the same id.", "en", "c", 4), (None, None, None, None, None),
    ]
    return spark.createDataFrame([r + (extra if i % 2 else none) for i, r in enumerate(rows)], f"{COLUMNS}, {CLASHING}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"{COLUMNS}, {CLASHING}")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
