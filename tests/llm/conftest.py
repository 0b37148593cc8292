import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, row_hash string, score string, label string"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows; columns beyond the table's own."""
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    texts = [
        (1, "the cat sat on the mat and the dog lay on the rug by the fire", "en", "a"),
        (2, "the cat sat on the mat and the dog lay on the rug by the fire", "en", "a"),
        (2, "the cat sat on the mat and the dog lay on the rug by the fire", "en", "a"),
        (3, None, None, None),
        (4, "", "de", ""),
        (5, " \t\n", "de", "b"),
        (6, long, "en", "b"),
        (7, "12345 !!! ???", None, "c"),
        (8, "ein Satz mit ö und ß", "de", None),
        (None, "nobody knows this one", "en", "a"),
        (None, None, None, None),
        (9, "word", "en", "c"),
    ]
    return [(i, t, lang, source, None if t is None else len(t), "x", None, "y", "z") for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
