import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, pos int, score double, batch string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns that clash with inner names."""
    prose = "the river runs to the sea and the boats of the town go with it as they have done for years"
    rows = [
        (5, prose, "en", "a", 1, 1, 0.5, "x"), (6, prose, "en", "a", 1, 1, 0.5, "x"), (6, prose, "en", "a", 1, 1, 0.5, "x"),
        (7, None, None, None, None, None, None, None), (8, "", "en", "b", 0, 0, 0.0, ""), (None, "stray words here", "en", "b", 3, 2, 0.1, "y"),
        (9, "  \n\t \n", "de", None, 5, 3, 0.2, "z"), (10, (prose + "\n") * 2000, "en", "a", 9, 1, 0.3, "x"),
        (11, "x" * 5000, None, "b", 5000, 1, 0.3, "x"), (12, prose + " and more\n" + prose, "en", "c", 1, 1, 0.3, "x"),
        (12, "another text with the same id", "en", "c", 1, 1, 0.3, "x"), (13, "É ñ 漢字 <|endoftext|> \\### </turn>", "fr", "c", 1, 1, 0.3, "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
