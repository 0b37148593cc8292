"""The jobs over stored history.  Each takes the raw input and returns the job's result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import alarms as al
from millrace.operators import logs, running, sessions, sliding, words
from millrace.operators.timeline import second_of
from millrace.session import staged


def print_batches(posts: DataFrame, rows: int = 10) -> DataFrame:
    """The first posts of every one-second batch, in order of arrival."""
    numbered = posts.select(second_of("ts").alias("batch"), "id", "text", (-F.col("id")).alias("_back"))
    return sliding.top_k_rows(numbered, ["batch"], rows, "_back").drop("_back")


def running_post_lengths(posts: DataFrame) -> DataFrame:
    return running.running_lengths(staged(running.batch_lengths(posts), "post-lengths"))


def popular_terms(posts: DataFrame, prefix: str = "$", window: int = 600, slide: int = 1, k: int = 10) -> DataFrame:
    return sliding.top_k_sliding(words.terms(posts, prefix), ["term"], "ts", window, slide, k)


def top_urls(log: DataFrame, window: int = 300, slide: int = 1, k: int = 10) -> DataFrame:
    return sliding.top_k_sliding(logs.url_requests(log), ["url"], "arrived", window, slide, k)


def top_agents(log: DataFrame, window: int = 300, slide: int = 1, k: int = 10) -> DataFrame:
    return sliding.top_k_sliding(logs.field_or_marker(log, "agent"), ["agent"], "arrived", window, slide, k)


def top_referrers(log: DataFrame, window: int = 300, slide: int = 1, k: int = 10) -> DataFrame:
    return sliding.top_k_sliding(logs.field_or_marker(log, "referer"), ["referer"], "arrived", window, slide, k)


def status_windows(log: DataFrame, width: str = "1 hour") -> DataFrame:
    """Requests per status and event-time window, in window order."""
    parsed = logs.parse_access_log(log, "drop", fields=["ts", "status"])
    return sliding.tumbling_counts(parsed, ["status"], "ts", width).orderBy("window", "status")


def alarm_history(log: DataFrame, **settings) -> DataFrame:
    return al.alarms(logs.classified_lines(log), "arrived", **settings)


def agents_per_batch(log: DataFrame) -> DataFrame:
    """Requests per agent within every one-second batch."""
    records = logs.request_records(log).withColumn("batch", second_of("arrived"))
    return records.groupBy("batch", "agent").agg(F.count("*").alias("total"))


def visitor_sessions(log: DataFrame, gap_seconds: int = 1800, keep: int = 10) -> DataFrame:
    hits = logs.visitor_hits(log)
    return sessions.sessions(hits, "ip", "arrived", "event_id", "url", gap_seconds, keep)
