"""Word and term streams out of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import is_term, split_space


def explode_words(df: DataFrame, text: str = "text", lower: bool = False) -> DataFrame:
    """One row per token in column ``word``, beside the other columns."""
    source = F.lower(F.col(text)) if lower else F.col(text)
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.explode(split_space(source)).alias("word"))


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of every lower-cased word.  Counted per input split before the shuffle."""
    return explode_words(df.select(text), text, lower=True).groupBy("word").agg(F.count("*").alias("n"))


def top_words(df: DataFrame, k: int = 20, text: str = "text") -> DataFrame:
    return word_count(df, text).orderBy(F.desc("n"), "word").limit(k)


def terms(df: DataFrame, prefix: str = "$", text: str = "text") -> DataFrame:
    """Upper-cased terms in column ``term``, filtered before any shuffle."""
    words = explode_words(df, text).where(is_term(F.col("word"), prefix))
    return words.withColumn("term", F.upper("word")).drop("word")
