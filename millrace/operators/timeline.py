"""Running values along a long timeline without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def second_of(ts: str) -> "F.Column":
    """Whole epoch seconds of a timestamp column."""
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def floor_to(value: "F.Column", step: int) -> "F.Column":
    return value - F.pmod(value, F.lit(step))


def prefix_scan(
    df: DataFrame,
    order: str,
    sums: Sequence[str] = (),
    maxes: Sequence[str] = (),
    chunk: int = DAY,
) -> DataFrame:
    """Add ``<c>_to_date`` for sums, ``<c>_so_far`` for maxes and ``prev`` (previous ``order``).

    ``order`` holds distinct integers.  Rows are scanned inside chunks of the order value, in
    parallel; then one row per chunk is scanned to find what each chunk starts from.  Only that
    summary (a row per day of history, whatever the number of rows) is ordered in a single task.
    """
    part = "_chunk"
    base = df.withColumn(part, floor_to(F.col(order), chunk)).repartition(part)
    inner = Window.partitionBy(part).orderBy(order)
    running = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.select(
        "*",
        *[F.sum(c).over(running).alias(f"_sum_{c}") for c in sums],
        *[F.max(c).over(running).alias(f"_max_{c}") for c in maxes],
        F.lag(order).over(inner).alias("_prev"),
    )
    summary = base.groupBy(part).agg(
        F.max(order).alias("_last"),
        *[F.sum(c).alias(f"_all_{c}") for c in sums],
        *[F.max(c).alias(f"_top_{c}") for c in maxes],
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        part,
        F.max("_last").over(before).alias("_carry_prev"),
        *[F.sum(f"_all_{c}").over(before).alias(f"_carry_sum_{c}") for c in sums],
        *[F.max(f"_top_{c}").over(before).alias(f"_carry_max_{c}") for c in maxes],
    )
    return local.join(carry, part).select(
        *df.columns,
        *[
            (F.col(f"_sum_{c}") + F.coalesce(F.col(f"_carry_sum_{c}"), F.lit(0))).alias(f"{c}_to_date")
            for c in sums
        ],
        *[F.greatest(f"_max_{c}", f"_carry_max_{c}").alias(f"{c}_so_far") for c in maxes],
        F.coalesce("_prev", "_carry_prev").alias("prev"),
    )
