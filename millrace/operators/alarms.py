"""Error-ratio and no-data alarms over a sliding window of classified log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.access_log import FAILURE, SUCCESS
from millrace.operators.sliding import clip, every_slide, sliding_intervals, step_counts
from millrace.operators.timeline import DAY, floor_to, prefix_scan
from millrace.session import staged

# Seconds of window, slide, silence and pause between alarms; least number of lines
# to judge; ratio above which an alarm is due.
WINDOW, SLIDE = 300, 1
MAX_SILENCE, ALARM_PAUSE = 30, 30
MIN_TOTAL, MAX_RATIO = 100, 0.5

ERROR_RATIO, NO_DATA = "error_ratio", "no_data"


def class_steps(classified: DataFrame, ts: str, slide: int = SLIDE) -> DataFrame:
    """Lines, successes and failures per slide step, at most one row per step of history.

    They are put aside, as the status of windows needs them twice.
    """
    kind = F.col("status_class")
    steps = step_counts(
        classified,
        [],
        ts,
        slide,
        {
            "success": F.when(kind == SUCCESS, 1).otherwise(0),
            "failure": F.when(kind == FAILURE, 1).otherwise(0),
        },
    )
    return staged(steps, "class-steps")


def error_ratio(success: Column, failure: Column, min_total: int = MIN_TOTAL) -> Column:
    """Failures per success; no success at all counts as infinite, too few lines give NULL."""
    ratio = F.coalesce(F.try_divide(failure, success), F.lit(float("inf")))
    return F.when(success + failure > min_total, ratio)


def window_state(ratio: Column, lines: Column, max_ratio: float = MAX_RATIO) -> Column:
    return (
        F.when(lines == 0, F.lit("empty"))
        .when(ratio.isNull(), F.lit("too_few"))
        .when(ratio > max_ratio, F.lit("alarm"))
        .otherwise(F.lit("ok"))
    )


def cut_stretches(stretches: DataFrame, width: int, slide: int = SLIDE) -> DataFrame:
    """Cut stretches at multiples of ``width`` so that none becomes an overlong array of slides."""
    last = F.col("until_t") - slide
    starts = F.sequence(
        floor_to(F.col("from_t"), width), floor_to(last, width), F.lit(width).cast("bigint")
    )
    others = [c for c in stretches.columns if c not in ("from_t", "until_t")]
    return stretches.select("*", F.explode(starts).alias("_at")).select(
        *others,
        F.greatest("from_t", "_at").alias("from_t"),
        F.least(F.col("until_t"), F.col("_at") + width).alias("until_t"),
    )


def silent_stretches(
    steps: DataFrame, window: int = WINDOW, slide: int = SLIDE, chunk: int = DAY, until: int | None = None
) -> DataFrame:
    """``(from_t, until_t, last_seen_t)``: runs of window ends whose window is empty.

    Silence after the last step is reported up to ``until``, if that is given.
    """
    marks = steps.select("step")
    if until is not None:
        closing = marks.sparkSession.range(1).select(F.lit(until).cast("bigint").alias("step"))
        marks = marks.unionByName(closing).distinct()
    scanned = prefix_scan(marks, "step", chunk=chunk)
    last_seen = F.col("prev") + window
    runs = scanned.where(F.col("step") > last_seen).select(
        (last_seen + slide).alias("from_t"), (F.col("step") + slide).alias("until_t"), last_seen.alias("last_seen_t")
    )
    return cut_stretches(runs, chunk, slide)


def window_status(
    steps: DataFrame,
    window: int = WINDOW,
    slide: int = SLIDE,
    min_total: int = MIN_TOTAL,
    max_ratio: float = MAX_RATIO,
    max_silence: int = MAX_SILENCE,
    chunk: int = DAY,
    after: int | None = None,
    until: int | None = None,
) -> DataFrame:
    """Totals, ratio and state for every window end between the first and the last line.

    ``overdue`` marks windows that have been empty for longer than ``max_silence`` seconds.  With
    ``after`` and ``until`` only window ends in between are given, and silence is reported up to there.
    """
    busy = sliding_intervals(steps, [], window, slide, ["success", "failure"]).select(
        "from_t", "until_t", F.lit(None).cast("bigint").alias("last_seen_t"), "n", "success", "failure"
    )
    none = F.lit(0).cast("bigint")
    silent = silent_stretches(steps, window, slide, chunk, until).select(
        "from_t", "until_t", "last_seen_t", none.alias("n"), none.alias("success"), none.alias("failure")
    )
    ratio = error_ratio(F.col("success"), F.col("failure"), min_total)
    judged = (
        busy.unionByName(silent)
        .withColumn("ratio", ratio)
        .withColumn("state", window_state(F.col("ratio"), F.col("n"), max_ratio))
    )
    overdue = F.coalesce(F.col("window_end") - F.col("last_seen_t") > max_silence, F.lit(False))
    return every_slide(clip(judged, after, until, slide), slide).withColumn("overdue", overdue).drop("last_seen_t")


def ratio_candidates(status: DataFrame) -> DataFrame:
    return status.where(F.col("state") == "alarm").select("window_end", F.lit(ERROR_RATIO).alias("kind"))


def no_data_candidates(status: DataFrame) -> DataFrame:
    return status.where("overdue").select("window_end", F.lit(NO_DATA).alias("kind"))


def issued_times(
    candidates: DataFrame, pause: int = ALARM_PAUSE, chunk: int = DAY, free_from: int | None = None
) -> DataFrame:
    """Window ends at which an alarm goes out: more than ``pause`` seconds after the last one.

    Each issued alarm depends on the one before, yet all a stretch of time needs to know of the past
    is how many of its first seconds are still blocked, 0 to ``pause``.  So every day is played
    through for each of these starting points in parallel, the days are chained through these small
    tables (one short row per day), and every day is played once more from its true start.
    """
    if free_from is not None:
        candidates = candidates.where(F.col("window_end") >= free_from)
    a_day = (
        candidates.select("window_end", floor_to(F.col("window_end"), chunk).alias("day"))
        .groupBy("day")
        .agg(F.array_sort(F.collect_set("window_end")).alias("due"))
    )
    played = f"""transform(sequence(0, {pause}), e -> aggregate(due, day + e,
        (free, t) -> if(t >= free, t + {pause} + 1, free)))"""
    tables = a_day.select("day", F.expr(played).alias("free_after"))
    chain = """aggregate(
        array_sort(collect_list(struct(day, free_after))),
        struct(cast(-9223372036854775808 AS BIGINT) AS free,
               cast(array() AS ARRAY<STRUCT<day: BIGINT, start: BIGINT>>) AS starts),
        (acc, d) -> struct(
            element_at(d.free_after, cast(greatest(acc.free, d.day) - d.day + 1 AS INT)) AS free,
            concat(acc.starts, array(struct(d.day AS day, greatest(acc.free, d.day) AS start))) AS starts),
        acc -> acc.starts)"""
    starts = tables.agg(F.expr(chain).alias("starts")).select(F.inline("starts"))
    replay = f"""aggregate(due, struct(start AS free, cast(array() AS ARRAY<BIGINT>) AS sent),
        (acc, t) -> if(t >= acc.free,
            struct(t + {pause} + 1 AS free, concat(acc.sent, array(t)) AS sent), acc),
        acc -> acc.sent)"""
    return a_day.join(starts, "day").select(F.explode(F.expr(replay)).alias("window_end"))


def alarm_log(
    candidates: DataFrame, pause: int = ALARM_PAUSE, chunk: int = DAY, free_from: int | None = None
) -> DataFrame:
    """Every candidate with its fate, ``issued`` or ``suppressed``."""
    sent = issued_times(candidates, pause, chunk, free_from).withColumn("sent", F.lit(True))
    action = F.when(F.col("sent"), F.lit("issued")).otherwise(F.lit("suppressed"))
    return candidates.join(sent, "window_end", "left").select("window_end", "kind", action.alias("action"))


def alarms(
    classified: DataFrame,
    ts: str,
    window: int = WINDOW,
    slide: int = SLIDE,
    min_total: int = MIN_TOTAL,
    max_ratio: float = MAX_RATIO,
    max_silence: int = MAX_SILENCE,
    pause: int = ALARM_PAUSE,
) -> DataFrame:
    """Both kinds of alarm under one shared pause."""
    steps = class_steps(classified, ts, slide)
    status = window_status(steps, window, slide, min_total, max_ratio, max_silence)
    wanted = status.where("state = 'alarm' OR overdue")
    due = wanted.select(
        "window_end", F.when(F.col("overdue"), F.lit(NO_DATA)).otherwise(F.lit(ERROR_RATIO)).alias("kind")
    )
    return alarm_log(staged(due, "alarms-due"), pause)
