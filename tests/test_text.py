import pytest
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import words


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v STRING").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, tokens",
    [("", [""]), (" ", []), ("   ", []), ("a b ", ["a", "b"]), (" a  b", ["", "a", "", "b"]), ("a \n", ["a", "\n"]), (None, None)],
)
def test_split_space(spark, value, tokens):
    assert one(spark, value, tx.split_space) == tokens


@pytest.mark.parametrize("value, units, points", [("a😀", 3, 2), ("abc", 3, 3), ("é", 1, 1), ("", 0, 0), (None, None, None)])
def test_length(spark, value, units, points):
    assert one(spark, value, tx.text_length) == units
    assert one(spark, value, lambda c: tx.text_length(c, "codepoint")) == points


def test_length_unit():
    with pytest.raises(ValueError):
        tx.text_length(F.lit("a"), "bytes")


@pytest.mark.parametrize(
    "word, wanted", [("$", False), ("$a", True), ("$1a", False), ("$a٣", False), ("#a", False), ("$straße", True), ("$a𝟘", True)]
)
def test_term(spark, word, wanted):
    assert one(spark, word, tx.is_term) is wanted


def test_terms_upper(spark):
    posts = spark.createDataFrame([("x $straße $a1  $b",)], "text STRING")
    assert sorted(r["term"] for r in words.terms(posts).collect()) == ["$B", "$STRASSE"]


def test_word_count(spark):
    lines = spark.createDataFrame([("The the  cat",), ("   ",), ("",), ("cat ",)], "text STRING")
    got = {r["word"]: r["n"] for r in words.word_count(lines).collect()}
    assert got == {"the": 2, "": 2, "cat": 2}
    assert [tuple(r) for r in words.top_words(lines, 2).collect()] == [("", 2), ("cat", 2)]
