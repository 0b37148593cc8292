"""Window status and alarms on a stream, and short windows by Spark's own chained windows.

A batch is counted per slide step; all lines of a step are one row, so a job carries the steps of one window length from
batch to batch.  Windows per key are in ``counts``.

No row is dropped.  A row that comes after windows it belongs to were put out still counts in all
windows that are open, and its step is written to ``<state>/late`` as well.  ``close`` puts out what
is left when a run has ended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import alarms as al
from millrace.operators.timeline import floor_to, second_of
from millrace.session import passing_scratch
from millrace.streaming.versions import VersionedTable

#: Writes what a batch uses several times; gone when the batch ends.
Staged = Callable[[DataFrame, str], DataFrame]


def step_rows(
    rows: DataFrame,
    by: Sequence[str],
    ts: str,
    slide: int = 1,
    measures: Mapping[str, Column] | None = None,
    counted: Column | None = None,
) -> DataFrame:
    """Rows as ``(<by>, step, n, measures)``, to be summed per batch; ``counted`` marks rows that count as events.

    Rows without a time have no step; batches leave them out and count them under ``late``.
    """
    flag = F.lit(1) if counted is None else F.when(counted, 1).otherwise(0)
    step = floor_to(second_of(ts), slide).alias("step")
    return rows.select(*by, step, flag.cast("bigint").alias("n"), *[m.cast("bigint").alias(k) for k, m in (measures or {}).items()])


def sliding_stream(
    rows: DataFrame, by: Sequence[str], ts: str, window: int = 300, slide: int = 1, delay: str = "10 seconds"
) -> DataFrame:
    """Window counts by two chained windows, all inside one streaming plan.  For short windows."""
    steps = (
        rows.withWatermark(ts, delay)
        .groupBy(F.window(ts, f"{slide} seconds").alias("step"), *by)
        .agg(F.count("*").alias("c"))
    )
    return (
        steps.groupBy(F.window(F.window_time("step"), f"{window} seconds", f"{slide} seconds").alias("w"), *by)
        .agg(F.sum("c").alias("n"))
        .select(F.unix_seconds("w.end").alias("window_end"), *by, "n")
    )


class StepBatches:
    """Marks of what is finished, late rows, and closing.

    Windows up to the newest step minus ``delay`` seconds are finished by a batch.
    """

    def __init__(
        self,
        state: str,
        by: Mapping[str, str],
        window: int = 300,
        slide: int = 1,
        delay: int = 0,
        measures: Sequence[str] = (),
    ):
        self.state, self.by = state.rstrip("/"), dict(by)
        self.window, self.slide, self.delay, self.measures = window, slide, delay, tuple(measures)
        self.columns = [f"{c} {t}" for c, t in self.by.items()]

    def table(self, spark: SparkSession, name: str, columns: Sequence[str], keep: int | None = 3) -> VersionedTable:
        return VersionedTable(spark, f"{self.state}/{name}", ", ".join(columns), keep)

    def marks(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "marks", ["until BIGINT", "newest BIGINT"])

    def summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.by, "step").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", *self.measures)])

    def report_late(self, steps: DataFrame, until: int | None, batch_id: int) -> None:
        """Writes steps of finished windows, and rows without a time; ``lost`` if no open window takes them."""
        finished = F.lit(False) if until is None else F.col("step") < until
        lost = F.col("step").isNull() if until is None else F.col("step").isNull() | (F.col("step") + self.window <= until)
        late = steps.where(F.col("step").isNull() | finished).select(*self.by, "step", "n", lost.alias("lost"))
        if not late.isEmpty():
            late.write.mode("overwrite").parquet(f"{self.state}/late/batch_id={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with passing_scratch(batch.sparkSession, "batch") as staged:
            self.take(staged(self.summed(batch), "steps"), batch_id, staged)

    def take(self, steps: DataFrame, batch_id: int, staged: Staged) -> None:
        spark = steps.sparkSession
        mark = self.marks(spark).before(batch_id).first()
        before, newest = (mark["until"], mark["newest"]) if mark else (None, None)
        self.report_late(steps, before, batch_id)
        seen = steps.agg(F.max("step").alias("s")).first()["s"]
        if seen is None:
            return
        newest = seen if newest is None else max(seen, newest)
        until = floor_step(newest - self.delay, self.slide)
        until = until if before is None else max(until, before)
        self.advance(spark, steps.where("step IS NOT NULL"), before, until, batch_id, staged)
        self.marks(spark).write(batch_id, spark.createDataFrame([(until, newest)], "until BIGINT, newest BIGINT"))

    def close(self, spark: SparkSession) -> None:
        """Puts out the windows that no batch finished, as the output of the next batch.

        Nothing carried changes: closing again gives the same, and a batch that comes later replaces it.
        """
        versions = self.marks(spark).versions()
        if versions:
            mark = self.marks(spark).read(versions[-1]).first()
            with passing_scratch(spark, "close") as staged:
                self.finish(spark, mark["until"], mark["newest"], versions[-1] + 1, staged)

    def advance(
        self, spark: SparkSession, steps: DataFrame, before: int | None, until: int, batch_id: int, staged: Staged
    ) -> None:
        raise NotImplementedError

    def finish(self, spark: SparkSession, before: int, newest: int, batch_id: int, staged: Staged) -> None:
        raise NotImplementedError


def floor_step(second: int, slide: int) -> int:
    return second - second % slide


class AlarmBatches(StepBatches):
    """Status of every finished window and the alarms due, under one pause kept across batches.

    All lines of a step are one row, so the steps of a window length are carried as they are.
    """

    def __init__(
        self,
        state: str,
        status_out: Callable[[DataFrame, int], None],
        alarm_out: Callable[[DataFrame, int], None],
        window: int = al.WINDOW,
        slide: int = al.SLIDE,
        delay: int = 0,
        min_total: int = al.MIN_TOTAL,
        max_ratio: float = al.MAX_RATIO,
        max_silence: int = al.MAX_SILENCE,
        pause: int = al.ALARM_PAUSE,
    ):
        super().__init__(state, {}, window, slide, delay, ("success", "failure"))
        self.status_out, self.alarm_out = status_out, alarm_out
        self.min_total, self.max_ratio, self.max_silence, self.pause = min_total, max_ratio, max_silence, pause

    def carried(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "steps", [f"{c} BIGINT" for c in ("step", "n", *self.measures)])

    def status(self, steps: DataFrame, after: int | None, until: int | None) -> DataFrame:
        """Only steps before ``until`` are complete; ticks (steps without lines) count for nothing but time."""
        lines = steps.where("n > 0") if until is None else steps.where((F.col("n") > 0) & (F.col("step") < until))
        return al.window_status(
            lines, self.window, self.slide, self.min_total, self.max_ratio, self.max_silence, after=after, until=until
        )

    def advance(
        self, spark: SparkSession, steps: DataFrame, before: int | None, until: int, batch_id: int, staged: Staged
    ) -> None:
        steps = staged(self.summed(self.carried(spark).before(batch_id).unionByName(steps)), "steps")
        self.judge(self.status(steps, before, until), batch_id, staged)
        # the last step with events stays too, to measure silence from
        seen = steps.where(F.col("n") > 0).where(F.col("step") < until).agg(F.max("step")).scalar()
        self.carried(spark).write(batch_id, steps.where((F.col("step") >= until - self.window) | (F.col("step") == seen)))

    def finish(self, spark: SparkSession, before: int, newest: int, batch_id: int, staged: Staged) -> None:
        self.judge(self.status(self.carried(spark).before(batch_id), before, None), batch_id, staged)

    def judge(self, windows: DataFrame, batch_id: int, staged: Staged) -> None:
        spark = windows.sparkSession
        last = self.table(spark, "issued", ["window_end BIGINT"])
        windows = staged(windows, "status")
        self.status_out(windows.drop("overdue"), batch_id)
        before = last.before(batch_id).first()
        due = windows.where("state = 'alarm' OR overdue").select(
            "window_end", F.when(F.col("overdue"), F.lit(al.NO_DATA)).otherwise(F.lit(al.ERROR_RATIO)).alias("kind")
        )
        log = staged(al.alarm_log(due, self.pause, free_from=before["window_end"] + self.pause + 1 if before else None), "alarms")
        self.alarm_out(log, batch_id)
        newest = log.where("action = 'issued'").agg(F.max("window_end").alias("window_end")).first()["window_end"]
        newest = newest if newest is not None else before["window_end"] if before else None
        if newest is not None:
            last.write(batch_id, spark.createDataFrame([(newest,)], "window_end BIGINT"))
