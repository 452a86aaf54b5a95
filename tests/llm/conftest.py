import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, rank int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    texts = [
        (1, base * 4), (2, base * 4), (3, base * 3 + "and some other words at the end of it"), (4, None), (5, ""), (6, "   \n\t "), (7, "word"),
        (8, "x" * 99), (9, "ab" * 300), (10, "é中🙂 " * 60), (11, "mail a.b@c.org or +1 (212) 555-1234 now, 10.0.0.1 or 4111 1111 1111 1111."), (None, base), (None, None),
        (12, base * 4), (12, base * 4), (13, "same id " * 40), (13, "other text " * 40), (14, "long text with words " * 20000),
    ]
    return spark.createDataFrame([(i, t, None, None, None, 0.5, None, 1) for i, t in texts], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
