"""Silence noticed by timers: no stream of ticks is needed.

Rows are reduced to one per second and task before they reach the one state of a monitor.  In event time the watermark is the clock:
what it has passed without a row is silent.  With ``clock`` the machine's clock is, rows count when they arrive, and
the timer fires in batches without input, so an alarm comes while nothing arrives at all.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators import alarms as al
from millrace.streaming.counts import counted_in_tasks


class SilenceProcessor(StatefulProcessor):
    """Stretches of window ends without a row that lie more than ``max_silence`` seconds behind the last window with one."""

    STATE = "last BIGINT, out BIGINT, ahead ARRAY<BIGINT>"

    def __init__(self, window: int, slide: int, max_silence: int, clock: bool):
        self.window, self.slide, self.max_silence, self.clock = window, slide, max_silence, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("silence", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self._now(timerValues)
        steps = {row["step"] for row in rows if row["step"] is not None}
        if steps and key[0] is not None:
            yield from self._passed(key, {now} if self.clock else steps, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._passed(key, set(), timerValues)

    def _now(self, timerValues) -> int:
        millis = timerValues.getCurrentProcessingTimeInMs() if self.clock else timerValues.getCurrentWatermarkInMs()
        return millis // 1000 - millis // 1000 % self.slide

    def _passed(self, key, steps: set[int], timerValues) -> Iterator[Row]:
        now = self._now(timerValues)
        last, out, ahead = self.state.get() or (None, now if self.clock else 0, [])
        waiting = sorted(steps | set(ahead))
        for step in [s for s in waiting if s <= now]:
            if last is None or step > last:
                yield from self._silent(key, last, out, step)
                out, last = max(out, step), step
        yield from self._silent(key, last, out, now)
        out = max(out, now)
        waiting = [s for s in waiting if s > now]
        self.state.update((last, out, waiting))
        first = out if last is None else max(out, last + self.window + self.max_silence)  # no window end up to here can be silent
        self.handle.registerTimer((first + self.slide) * 1000 if self.clock else timerValues.getCurrentWatermarkInMs() + 1)

    def _silent(self, key, last: int | None, out: int, until: int) -> Iterator[Row]:
        if last is not None:
            begin = max(last + self.window + self.max_silence, out) + self.slide
            if begin <= until:
                yield Row(key=key[0], from_t=begin, until_t=until + self.slide)


def silences(
    rows: DataFrame, ts: str, window: int = al.WINDOW, slide: int = al.SLIDE, max_silence: int = al.MAX_SILENCE, delay: int = 0,
    clock: bool = False, name: str = "rows",
) -> DataFrame:
    """``key`` (the monitor's ``name``), ``from_t, until_t``: stretches of silent window ends, as a stream.

    Rows may come ``delay`` seconds late in event time; rows without a time tell nothing.  Needs the RocksDB state store.
    """
    steps = counted_in_tasks(rows.select(F.lit(name).alias("monitor"), ts), "monitor", "STRING", ts, slide)
    steps = steps if clock else steps.withWatermark("at", f"{delay} seconds")
    return steps.groupBy("key").transformWithState(
        statefulProcessor=SilenceProcessor(window, slide, max_silence, clock),
        outputStructType="key STRING, from_t BIGINT, until_t BIGINT",
        outputMode="Append",
        timeMode="ProcessingTime" if clock else "EventTime",
    )
