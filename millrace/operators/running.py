"""Running totals, averages and maxima of post lengths, per one-second batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import text_length
from millrace.operators.timeline import DAY, prefix_scan, second_of
from millrace.session import staged


def batch_lengths(posts: DataFrame, ts: str = "ts", text: str = "text", unit: str = "utf16") -> DataFrame:
    """Posts, characters and longest post of every second that has posts."""
    lengths = posts.select(second_of(ts).alias("batch"), text_length(F.col(text), unit).alias("length"))
    return lengths.groupBy("batch").agg(
        F.count("*").alias("posts"), F.sum("length").alias("chars"), F.max("length").alias("batch_max")
    )


def running_lengths(batches: DataFrame, chunk: int = DAY) -> DataFrame:
    """Totals since the start, integer average and maximum so far, for every non-empty second."""
    scanned = prefix_scan(batches, "batch", sums=("posts", "chars"), maxes=("batch_max",), chunk=chunk)
    return scanned.select(
        "batch",
        F.col("posts_to_date").alias("total_posts"),
        F.col("chars_to_date").alias("total_chars"),
        F.expr("chars_to_date div posts_to_date").alias("average"),
        "batch_max",
        F.col("batch_max_so_far").alias("max_so_far"),
    )


def total_lengths(posts: DataFrame, text: str = "text", unit: str = "utf16") -> DataFrame:
    """One row of totals over everything seen; on a stream, complete mode keeps it up to date."""
    lengths = posts.select(text_length(F.col(text), unit).alias("length"))
    totals = lengths.agg(
        F.count("*").alias("total_posts"), F.sum("length").alias("total_chars"), F.max("length").alias("max_so_far")
    )
    return totals.select("*", F.expr("total_chars div total_posts").alias("average")).where("total_posts > 0")


def stop_after(posts: DataFrame, limit: int = 1000, ts: str = "ts", chunk: int = DAY) -> DataFrame:
    """The posts a saver keeps that stops once more than ``limit`` posts are written.

    The check follows the write, so the second in which the bound is passed is kept whole.
    """
    second = second_of(ts)
    per_second = staged(posts.groupBy(second.alias("batch")).agg(F.count("*").alias("n")), "posts-per-second")
    # the bound is passed once, so the kept seconds are all up to the last one that starts below it
    kept = prefix_scan(per_second, "batch", sums=("n",), chunk=chunk).where(F.col("n_to_date") - F.col("n") <= limit)
    last = kept.agg(F.max("batch").alias("last")).scalar()
    return posts.where(second <= last)
