import pytest

#: Texts that every operator must handle.
ODD = [
    None,
    "",
    " \n\t ",
    "word",
    "a",
    "Straße É ñ 漢字 🙂 ​",
    "x" * 3000,
    "one two " * 3000,
    "1.2.3.4 a@b.cd",
    "the the the the",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts with repeated rows, ties, null ids and columns that clash with inner names."""
    rows = [(i, text, i) for i, text in enumerate(ODD)]
    rows += [(3, "word", 3), (3, "word", 3), (None, "word", 1), (None, None, 2), (50, "x" * 3000, 1), (51, "one two " * 3000, 1)]
    full = [(i, t, "en", "src0", 1, "h", k, "b", "r", 7, "c") for i, t, k in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, hash string, fp long, bucket string, ranges string, id long, row string"
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
