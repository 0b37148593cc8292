"""Sliding counts over event time, without expanding every row into all its windows.

A window is named by its end ``T`` (epoch seconds, a multiple of the slide) and covers
``[T - window, T)``.  A key without events in a window has no row for it.

Rows are first counted per key and slide step.  Each count then adds at the first window that sees
it and is taken off after the last one; a running sum gives the window counts.  The sum is cut into
fixed stretches of time, so that the work on one key is bounded by the length of a stretch and the
busiest key spreads over as many tasks as there are stretches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.timeline import floor_to, second_of

HOUR = 3_600


def _checked(window: int, slide: int, chunk: int) -> int:
    if slide <= 0 or window % slide:
        raise ValueError("the window has to be a multiple of the slide")
    return max(-(-chunk // slide), window // slide + 1) * slide


def step_counts(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    slide: int = 1,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows ``n`` (and the sums of further per-row ``measures``) per key and slide step ``step``."""
    measures = dict(measures or {})
    rows = df.select(
        *by, floor_to(second_of(ts), slide).alias("step"), *[m.alias(name) for name, m in measures.items()]
    ).where(F.col("step").isNotNull())
    return rows.groupBy(*by, "step").agg(
        F.count("*").alias("n"), *[F.sum(name).cast("bigint").alias(name) for name in measures]
    )


def sliding_intervals(
    steps: DataFrame,
    by: Sequence[str],
    window: int = 300,
    slide: int = 1,
    measures: Sequence[str] = (),
    chunk: int = HOUR,
) -> DataFrame:
    """Window counts as stretches: ``n`` holds for every window end in ``[from_t, until_t)``.

    Stretches are cut at multiples of ``chunk``; their number follows the number of step counts,
    not the window length.
    """
    chunk = _checked(window, slide, chunk)
    values = ["n", *measures]
    first, after = F.col("step") + slide, F.col("step") + window + slide
    first_chunk, after_chunk = floor_to(first, chunk), floor_to(after, chunk)

    def edge(part: Column, at: Column, sign: int) -> Column:
        signed = [(F.col(v) * sign).alias(v) for v in values]
        return F.struct(part.alias("part"), at.alias("from_t"), *signed)

    crossing = F.array(edge(first_chunk, first, 1), edge(after_chunk, after_chunk, 1), edge(after_chunk, after, -1))
    ending = F.array(edge(first_chunk, first, 1))  # leaves exactly where the next stretch of time begins
    inside = F.array(edge(first_chunk, first, 1), edge(first_chunk, after, -1))
    edges = (
        F.when(first_chunk == after_chunk, inside).when(after == after_chunk, ending).otherwise(crossing)
    )
    moved = steps.select(*by, F.explode(edges).alias("e")).select(*by, "e.*")
    # one shuffle serves the sum per instant and the running sum
    merged = (
        moved.repartition(*by, "part")
        .groupBy(*by, "part", "from_t")
        .agg(*[F.sum(v).alias(v) for v in values])
        .where(" OR ".join(f"{v} <> 0" for v in values))
    )
    line = Window.partitionBy(*by, "part").orderBy("from_t")
    running = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return merged.select(
        *by,
        "part",
        "from_t",
        F.coalesce(F.lead("from_t").over(line), F.col("part") + chunk).alias("until_t"),
        *[F.sum(v).over(running).alias(v) for v in values],
    ).where("n > 0")


def clip(intervals: DataFrame, after: int | None = None, until: int | None = None, slide: int = 1) -> DataFrame:
    """Only the window ends later than ``after`` and not later than ``until``, still as stretches."""
    low = F.col("from_t") if after is None else F.greatest(F.col("from_t"), F.lit(after + slide))
    high = F.col("until_t") if until is None else F.least(F.col("until_t"), F.lit(until + slide))
    return intervals.withColumns({"from_t": low, "until_t": high}).where("from_t < until_t")


def every_slide(intervals: DataFrame, slide: int = 1) -> DataFrame:
    """One row per window end out of stretches."""
    others = [c for c in intervals.columns if c not in ("from_t", "until_t", "part")]
    ends = F.sequence(F.col("from_t"), F.col("until_t") - slide, F.lit(slide).cast("bigint"))
    return intervals.select(F.explode(ends).alias("window_end"), *others)


def sliding_counts(
    df: DataFrame, by: Sequence[str], ts: str, window: int = 300, slide: int = 1, chunk: int = HOUR
) -> DataFrame:
    """``n`` per key and window end, for every slide in which the key has events."""
    return every_slide(sliding_intervals(step_counts(df, by, ts, slide), by, window, slide, chunk=chunk), slide)


def expanded_counts(df: DataFrame, by: Sequence[str], ts: str, window: int = 300, slide: int = 1) -> DataFrame:
    """The same counts by the built-in window function, which copies each row per window.

    Works on streams; on history it is the yardstick for ``sliding_counts``.
    """
    spans = F.window(F.col(ts), f"{window} seconds", f"{slide} seconds")
    return (
        df.groupBy(*by, spans.alias("w"))
        .agg(F.count("*").alias("n"))
        .select(F.unix_seconds("w.end").alias("window_end"), *by, "n")
    )


def top_k_rows(df: DataFrame, group: Sequence[str], k: int, value: str, *ties: str) -> DataFrame:
    """First ``k`` rows per group by descending ``value``, ties in the order of ``ties``.

    The rank limit is applied by each task to its own rows before the shuffle, so a group never
    arrives whole anywhere.
    """
    order = Window.partitionBy(*group).orderBy(F.desc(value), *ties)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k_sliding(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    window: int = 300,
    slide: int = 1,
    k: int = 10,
    block: int = 60,
    chunk: int = HOUR,
) -> DataFrame:
    """The ``k`` most frequent keys of every window: ``window_end, rank, <by>, n``.

    Before stretches become one row per slide, those that cannot rank are left out, exactly: within
    a block of time, a key that stays at ``m`` or above in all windows of the block has ``m`` as
    its floor.  With the k-th largest floor as the mark, at least ``k`` keys reach the mark in
    every window of the block, so a stretch below the mark is never among the first ``k``.
    """
    by = list(by)
    block = max(-(-block // slide), 1) * slide
    # stretches of time hold whole blocks, so that no block is seen in two parts
    chunk = -(-_checked(window, slide, chunk) // block) * block
    return rank_intervals(sliding_intervals(step_counts(df, by, ts, slide), by, window, slide, chunk=chunk), by, k, slide, block)


def able_intervals(intervals: DataFrame, by: Sequence[str], k: int, slide: int = 1, block: int = 60) -> DataFrame:
    """Stretches cut at multiples of ``block`` without those that cannot be among the first ``k`` of any window."""
    starts = F.sequence(
        floor_to(F.col("from_t"), block), floor_to(F.col("until_t") - slide, block), F.lit(block).cast("bigint")
    )
    cut = intervals.select("*", F.explode(starts).alias("block")).select(
        *by,
        "block",
        F.greatest("from_t", "block").alias("from_t"),
        F.least(F.col("until_t"), F.col("block") + block).alias("until_t"),
        "n",
    )
    whole = F.sum(F.col("until_t") - F.col("from_t")) == block
    floors = cut.groupBy(*by, "block").agg(F.when(whole, F.min("n")).otherwise(F.lit(0)).alias("floor"))
    marks = (
        top_k_rows(floors, ["block"], k, "floor")
        .groupBy("block")
        .agg(F.min("floor").alias("mark"), F.count("*").alias("keys"))
        .where(F.col("keys") == k)
        .select("block", "mark")
    )
    able = cut.join(marks, "block", "left").where(F.col("mark").isNull() | (F.col("n") >= F.col("mark")))
    return able.select(*by, "from_t", "until_t", "n")


def rank_intervals(intervals: DataFrame, by: Sequence[str], k: int, slide: int = 1, block: int = 60) -> DataFrame:
    """``window_end, rank, <by>, n`` of the first ``k`` keys of every window out of stretches (``from_t, until_t, n``)."""
    slides = every_slide(able_intervals(intervals, by, k, slide, max(-(-block // slide), 1) * slide), slide)
    return top_k_rows(slides, ["window_end"], k, "n", *by).select("window_end", "rank", *by, "n")


def tumbling_counts(df: DataFrame, by: Sequence[str], ts: str, width: str = "1 hour") -> DataFrame:
    """Rows per key and tumbling event-time window; batch and stream alike."""
    return df.groupBy(*by, F.window(F.col(ts), width).alias("window")).agg(F.count("*").alias("n"))
