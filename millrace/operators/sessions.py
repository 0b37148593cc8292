"""Visitor sessions over stored hits: hit count, span and the first items of each session.

A hit more than the gap after the visitor's previous one starts a new session; a gap of exactly
the limit does not.

Hits of one visitor that fall into the same gap-long piece of time always share a session.  So hits
are first reduced per visitor and piece (counts before the shuffle, first items by a rank limit
before the shuffle), and only these pieces are put in order per visitor.  The busiest visitor costs
two pieces per gap of history, not a sort of all its hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.timeline import floor_to


def session_pieces(
    hits: DataFrame, key: str, ts: str, seq: str, item: str, gap_seconds: int = 1800, keep: int = 10
) -> DataFrame:
    """``(key, piece, n, first_at, last_at, items)``: per visitor and piece, one row of counts and one of items."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = hits.select(F.col(key), at.alias("at"), F.col(seq).alias("seq"), F.col(item).alias("item"))
    rows = rows.select("*", floor_to(F.col("at"), gap_seconds * 1_000_000).alias("piece"))
    counts = rows.groupBy(key, "piece").agg(
        F.count("*").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    in_order = Window.partitionBy(key, "piece").orderBy("at", "seq")
    firsts = (
        rows.withColumn("r", F.row_number().over(in_order))
        .where(F.col("r") <= keep)
        .groupBy(key, "piece")
        .agg(F.sort_array(F.collect_list(F.struct("at", "seq", "item"))).alias("items"))
    )
    nothing = F.lit(None)
    return counts.select("*", nothing.cast(firsts.schema["items"].dataType).alias("items")).unionByName(
        firsts.select(
            key,
            "piece",
            F.lit(0).cast("bigint").alias("n"),
            nothing.cast("bigint").alias("first_at"),
            nothing.cast("bigint").alias("last_at"),
            "items",
        )
    )


def join_pieces(pieces: DataFrame, key: str, gap_seconds: int = 1800, keep: int = 10) -> DataFrame:
    """Sessions out of pieces: ``(key, first_at, last_at, n, items, latest)``.

    Several rows may describe one piece.  One shuffle by visitor serves all steps.
    """
    whole = (
        pieces.repartition(key)
        .groupBy(key, "piece")
        .agg(
            F.sum("n").alias("n"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
    )
    line = Window.partitionBy(key).orderBy("piece")
    # the latest hit of all earlier pieces: a session carried along may reach past the piece after it
    silence = F.col("first_at") - F.max("last_at").over(line.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(silence <= gap_seconds * 1_000_000, F.lit(0)).otherwise(F.lit(1))
    numbered = whole.withColumn("starts", starts).withColumn("session", F.sum("starts").over(line))
    earlier = Window.partitionBy(key, "session").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    # a piece can hold first items only while fewer than ``keep`` hits precede it; a session carried along reaches
    # past its piece, and its hits need not precede those of the pieces inside its span
    within = F.when(F.col("last_at") < F.col("piece") + gap_seconds * 1_000_000, F.col("n")).otherwise(F.lit(0))
    needed = F.coalesce(F.sum(within).over(earlier), F.lit(0)) < keep
    trimmed = numbered.withColumn("items", F.when(needed, F.col("items")))
    found = trimmed.groupBy(key, "session").agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.sum("n").alias("n"),
        F.slice(F.sort_array(F.flatten(F.collect_list("items"))), 1, keep).alias("items"),
    )
    newest = F.max("session").over(Window.partitionBy(key))
    return found.withColumn("latest", F.col("session") == newest).drop("session")


def session_rows(joined: DataFrame, key: str) -> DataFrame:
    """``(key, session_start, last_hit, session_length, clickstream)``."""
    return joined.select(
        key,
        F.timestamp_micros("first_at").alias("session_start"),
        F.timestamp_micros("last_at").alias("last_hit"),
        F.col("n").alias("session_length"),
        F.col("items.item").alias("clickstream"),
    )


def sessions(
    hits: DataFrame, key: str, ts: str, seq: str, item: str, gap_seconds: int = 1800, keep: int = 10
) -> DataFrame:
    """``(key, session_start, last_hit, session_length, clickstream)``."""
    pieces = session_pieces(hits, key, ts, seq, item, gap_seconds, keep)
    return session_rows(join_pieces(pieces, key, gap_seconds, keep).drop("latest"), key)


def session_snapshot(found: DataFrame, key: str, gap_seconds: int = 1800, at: str | None = None) -> DataFrame:
    """The latest session of every visitor.

    With ``at`` (a timestamp literal) only sessions that are still open at that moment.
    """
    latest = found.groupBy(key).agg(
        F.max_by(F.struct("session_start", "last_hit", "session_length", "clickstream"), "session_start").alias("s")
    ).select(key, "s.*")
    if at is None:
        return latest
    moment = F.lit(at).cast("timestamp")
    return latest.where(
        (F.col("session_start") <= moment)
        & (F.unix_micros(moment) - F.unix_micros("last_hit") <= gap_seconds * 1_000_000)
    )
