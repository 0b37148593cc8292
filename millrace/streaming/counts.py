"""Sliding windows in Spark's own state store.

A batch is counted per key and second in each task before anything is moved.  Each key then has one state
(``transformWithState``): the seconds that open windows still hold, and up to where its windows are out.  Event-time timers bring
up every key that still counts when the watermark moves, whether or not it has new rows, so that all
keys put out the same windows in the same batch, as stretches of time in which the count does not change.

No row is dropped.  Rows carry no event time towards the state store (only one row per task tells the newest time), so rows behind the
watermark arrive too: they count in all windows that are still open, and are handed out as late besides.  Spark may drop and count
a row that only tells an old time; nothing else is in it.
What is still open when a run has ended is read from the state store by ``close``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.sliding import rank_intervals, sliding_intervals
from millrace.operators.timeline import floor_to, second_of


def counted_in_tasks(rows: DataFrame, by: str, kind: str, ts: str, slide: int) -> DataFrame:
    """``<by>, step, n`` summed within each Arrow batch, and a row without them that tells the batch's newest time, ``at``.

    Rows without a time have no step.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(["key", "step"]).aggregate([([], "count_all")])
            newest = pa.compute.max(batch.column("step"))
            columns = [sums["key"], sums["step"], sums["count_all"].cast(pa.int64()), pa.nulls(len(sums), pa.int64())]
            clock = [pa.nulls(1, c.type) for c in columns[:3]] + [pa.array([newest.as_py()], pa.int64())]
            for part in (columns, clock):
                yield from pa.table(part, names=["key", "step", "n", "at"]).combine_chunks().to_batches()

    steps = rows.select(F.col(by).alias("key"), floor_to(second_of(ts), slide).alias("step"))
    sums = steps.mapInArrow(run, f"key {kind}, step bigint, n bigint, at bigint")
    return sums.withColumn("at", F.timestamp_seconds("at"))


class SlidingCounts(StatefulProcessor):
    """The seconds of a key that open windows hold; puts out the windows that the watermark has passed."""

    STATE = "until BIGINT, steps ARRAY<BIGINT>, counts ARRAY<BIGINT>"
    OUT = "step BIGINT, from_t BIGINT, until_t BIGINT, n BIGINT, lost BOOLEAN"

    def __init__(self, window: int, slide: int):
        self.window, self.slide = window, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("counts", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        until, counts = self._held(timerValues)
        yield from self._passed(key, until, counts, timerValues)
        mark = self._mark(timerValues)
        for row in rows:
            step, n = row["step"], row["n"]
            if step is None:
                if n is not None:  # not the row that tells the time
                    yield self._row(key, None, None, None, n, True)
                continue
            if step < mark:
                yield self._row(key, step, None, None, n, step + self.window <= mark)
            if step + self.window > mark:
                counts[step] = counts.get(step, 0) + n
        self._keep(mark, counts, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until, counts = self._held(timerValues)
        if until < self._mark(timerValues):
            yield from self._passed(key, until, counts, timerValues)
            self._keep(self._mark(timerValues), counts, timerValues)

    def _mark(self, timerValues) -> int:
        second = timerValues.getCurrentWatermarkInMs() // 1000
        return second - second % self.slide

    def _held(self, timerValues) -> tuple[int, dict[int, int]]:
        held = self.state.get()
        return (held[0], dict(zip(held[1], held[2], strict=True))) if held else (self._mark(timerValues), {})

    def _keep(self, mark: int, counts: dict[int, int], timerValues) -> None:
        open_ = sorted((s, n) for s, n in counts.items() if s + self.window > mark)
        if open_:
            self.state.update((mark, [s for s, _ in open_], [n for _, n in open_]))
            self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + 1)
        else:
            self.state.clear()

    def _passed(self, key, until: int, counts: dict[int, int], timerValues) -> Iterator[Row]:
        """Stretches of the window ends after ``until`` that the watermark has passed."""
        first, end = until + self.slide, self._mark(timerValues) + self.slide
        edges: dict[int, int] = {}
        for step, n in counts.items():
            begin, leave = max(step + self.slide, first), step + self.window + self.slide
            if begin < min(leave, end):
                edges[begin] = edges.get(begin, 0) + n
                edges[leave] = edges.get(leave, 0) - n
        level, times = 0, sorted(at for at, change in edges.items() if change and at < end)
        for i, at in enumerate(times):
            level += edges[at]
            if level:
                yield self._row(key, None, at, times[i + 1] if i + 1 < len(times) else end, level, None)

    def _row(self, key, step, from_t, until_t, n, lost) -> Row:
        return Row(key=key[0], step=step, from_t=from_t, until_t=until_t, n=n, lost=lost)


class TopWindows:
    """The ``k`` most frequent keys of every finished window, as ``window_end, rank, <by>, n``, through ``out(windows, batch id)``.

    ``late(rows, batch id)`` gets the steps of rows behind the watermark as ``<by>, step, n, lost``, ``lost`` where no open window
    takes them, and rows without a time.  Use it as the function of a streaming query over ``stretches``.
    """

    def __init__(self, checkpoint: str, out: Callable[[DataFrame, int], None], by: str, kind: str = "STRING", k: int = 10, window: int = 300,
                 slide: int = 1, delay: int = 0, late: Callable[[DataFrame, int], None] | None = None):
        self.checkpoint, self.out, self.by, self.kind, self.k = checkpoint, out, by, kind, k
        self.window, self.slide, self.delay, self.late = window, slide, delay, late

    def stretches(self, rows: DataFrame, ts: str) -> DataFrame:
        """The streaming frame to run.  Needs the RocksDB state store."""
        sums = counted_in_tasks(rows, self.by, self.kind, ts, self.slide).withWatermark("at", f"{self.delay} seconds")
        return sums.groupBy("key").transformWithState(
            statefulProcessor=SlidingCounts(self.window, self.slide),
            outputStructType=f"key {self.kind}, {SlidingCounts.OUT}",
            outputMode="Append",
            timeMode="EventTime",
        )

    def ranked(self, stretches: DataFrame) -> DataFrame:
        return rank_intervals(stretches.withColumnRenamed("key", self.by), [self.by], self.k, self.slide)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # a few rows per key; running the batch twice would run its state twice
        try:
            self.out(self.ranked(batch.where("lost IS NULL").select("key", "from_t", "until_t", "n")), batch_id)
            rows = batch.where("lost IS NOT NULL").select(F.col("key").alias(self.by), "step", "n", "lost")
            if self.late and not rows.isEmpty():
                self.late(rows, batch_id)
        finally:
            batch.unpersist()

    def close(self, spark: SparkSession) -> None:
        """Puts out the windows that no batch has finished, as the output of the next batch.

        The state stays as it is: closing again gives the same, and a batch that comes later replaces it.
        """
        last = spark.read.format("state-metadata").load(self.checkpoint).agg(F.max("maxBatchId")).first()[0]
        if last is None:
            return
        held = spark.read.format("statestore").option("stateVarName", "counts").load(self.checkpoint)
        steps = held.select(
            F.col("key.key").alias("key"), F.col("value.until").alias("until"), F.explode(F.arrays_zip("value.steps", "value.counts")).alias("s")
        ).select("key", "until", F.col("s.steps").alias("step"), F.col("s.counts").alias("n"))
        whole = sliding_intervals(steps, ["key", "until"], self.window, self.slide)
        after = F.greatest(F.col("from_t"), F.col("until") + self.slide)
        self.out(self.ranked(whole.select("key", after.alias("from_t"), "until_t", "n").where("from_t < until_t")), last + 1)


def to_folder(folder: str, rows: DataFrame, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def late_to(folder: str) -> Callable[[DataFrame, int], None]:
    """Late rows as Parquet, a folder per batch that has any."""
    return partial(to_folder, folder.rstrip("/"))
