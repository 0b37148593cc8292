"""Visitor sessions on a stream.

``SessionBatches`` joins each batch to the open sessions with the batch operators: all work stays
native and a busy visitor is reduced before any shuffle.  ``SessionProcessor`` keeps one state per
visitor in the state store and answers every hit with the session so far.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators import sessions as ops
from millrace.operators.timeline import floor_to
from millrace.streaming.versions import VersionedTable


class SessionBatches:
    """``out(closed, batch id)`` gets the sessions that ended, ``snapshot(open, batch id)`` those still open.

    A session ends once a hit more than the gap and ``delay_seconds`` later has been seen, from any
    visitor.  Hits that come later than that start a session of their own.  ``seq`` orders hits of the
    same time; without it, they keep the order in which the batch holds them.
    """

    def __init__(
        self,
        state: str,
        out: Callable[[DataFrame, int], None],
        snapshot: Callable[[DataFrame, int], None] | None = None,
        key: str = "ip",
        kind: str = "STRING",
        ts: str = "ts",
        seq: str | None = None,
        item: str = "url",
        gap_seconds: int = 1800,
        keep: int = 10,
        delay_seconds: int = 10,
    ):
        self.state, self.out, self.snapshot = state.rstrip("/"), out, snapshot
        self.key, self.ts, self.seq, self.item = key, ts, seq or "seq", item
        self.numbered = seq is not None
        self.gap, self.keep, self.delay = gap_seconds, keep, delay_seconds
        self.schema = (
            f"{key} {kind}, piece BIGINT, n BIGINT, first_at BIGINT, last_at BIGINT, "
            "items ARRAY<STRUCT<at: BIGINT, seq: BIGINT, item: STRING>>"
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, gap = batch.sparkSession, self.gap * 1_000_000
        carried = VersionedTable(spark, f"{self.state}/open", self.schema)
        clock = VersionedTable(spark, f"{self.state}/clock", "at BIGINT")
        if not self.numbered:
            batch = batch.withColumn(self.seq, F.monotonically_increasing_id())
        batch = batch.persist()
        try:
            newest = batch.agg(F.max(F.unix_micros(F.col(self.ts).cast("timestamp"))).alias("at")).first()["at"]
            before = clock.before(batch_id).first()
            if newest is None:
                return
            now = max(newest, before["at"] if before else newest)
            new = ops.session_pieces(batch, self.key, self.ts, self.seq, self.item, self.gap, self.keep)
            joined = ops.join_pieces(carried.before(batch_id).unionByName(new), self.key, self.gap, self.keep).persist()
            over = F.col("last_at") < now - gap - self.delay * 1_000_000
            self.out(ops.session_rows(joined.where(over), self.key), batch_id)
            still_open = joined.where(~over)
            if self.snapshot:
                self.snapshot(ops.session_rows(still_open.where("latest"), self.key), batch_id)
            carried.write(
                batch_id,
                still_open.select(
                    self.key, floor_to(F.col("first_at"), gap).alias("piece"), "n", "first_at", "last_at", "items"
                ),
            )
            clock.write(batch_id, spark.createDataFrame([(now,)], "at BIGINT"))
            joined.unpersist()
        finally:
            batch.unpersist()


class SessionProcessor(StatefulProcessor):
    """Session state per visitor for ``transformWithState``.

    ``each_hit`` answers every hit with its ``seq``; otherwise each batch gives the visitor's latest state once.  Rows
    with ``closed`` set report a session that ended.

    In event time the rows of a batch are put in time order and cut at gaps here, because timers fire only between batches; a timer ends
    the last session once the watermark is past its gap.  With ``idle`` a session ends once no hit has arrived for the gap, by the
    clock, whatever the hits' own times; its timer fires in batches without input too.

    The hits of one visitor in one batch are held in memory, so bound the batch at its source (``maxFilesPerTrigger``); where a single
    visitor may be huge, ``SessionBatches`` is the form to use.
    """

    STATE = "first_us BIGINT, last_us BIGINT, n BIGINT, clicks ARRAY<STRING>, timer BIGINT"

    def __init__(self, seq: str = "seq", item: str = "url", gap_seconds: int = 1800, keep: int = 10, each_hit: bool = True, idle: bool = False):
        self.seq, self.item, self.keep, self.each_hit, self.idle = seq, item, keep, each_hit, idle
        self.gap_us = gap_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", self.STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """A visitor's last session out of stored history; one that the watermark has passed ends in the first batch."""
        first, last, n, clicks = (initialState[c] for c in ("first_us", "last_us", "n", "clicks"))
        self._keep(first, last, n, list(clicks), None, timerValues)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        hits = sorted(((row["at_us"], row[self.seq], row[self.item]) for row in rows), key=lambda hit: hit[:2])
        first, last, n, clicks, timer = self.session.get() if self.session.exists() else (None, None, 0, [], None)
        clicks = list(clicks)
        for at, seq, item in hits:
            if not self.idle and last is not None and (at - last > self.gap_us or first - at > self.gap_us):
                yield self._row(key, None, first, last, n, clicks, True)
                first, last, n, clicks = None, None, 0, []
            first = at if first is None else min(first, at)
            last = at if last is None else max(last, at)
            n += 1
            if len(clicks) < self.keep:
                clicks.append(item)
            if self.each_hit:
                yield self._row(key, seq, first, last, n, clicks, False)
        if not self.each_hit:
            yield self._row(key, None, first, last, n, clicks, False)
        self._keep(first, last, n, clicks, timer, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.session.exists():
            first, last, n, clicks, timer = self.session.get()
            if timer == expiredTimerInfo.getExpiryTimeInMs():
                yield self._row(key, None, first, last, n, list(clicks), True)
                self.session.clear()

    def _keep(self, first, last, n, clicks, timer, timerValues) -> None:
        from_us = timerValues.getCurrentProcessingTimeInMs() * 1000 if self.idle else last
        due = -(-(from_us + self.gap_us) // 1000)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if timer != due:
            self.handle.registerTimer(due)
        self.session.update((first, last, n, clicks, due))

    def _row(self, key, seq, first, last, n, clicks, closed) -> Row:
        return Row(key=key[0], seq=seq, first_us=first, last_us=last, n=n, clicks=list(clicks), closed=closed)


def session_columns(key: str) -> list[Column]:
    return [
        F.col("key").alias(key),
        F.timestamp_micros("first_us").alias("session_start"),
        F.timestamp_micros("last_us").alias("last_hit"),
        F.col("n").alias("session_length"),
        F.col("clicks").alias("clickstream"),
    ]


def session_updates(
    hits: DataFrame,
    key: str = "ip",
    kind: str = "STRING",
    ts: str = "ts",
    seq: str = "seq",
    item: str = "url",
    gap_seconds: int = 1800,
    keep: int = 10,
    each_hit: bool = True,
    delay: str = "10 seconds",
    idle: bool = False,
    initial: DataFrame | None = None,
) -> DataFrame:
    """The session after every hit, as a stream: the session's columns, ``seq`` of the hit, and ``closed``.

    ``initial`` (sessions as the batch operators give them, the latest of each visitor) is what the stream takes over from; without it every
    visitor starts anew.  ``idle``: see ``SessionProcessor``.  Needs the RocksDB state store.
    """
    rows = hits.withColumn("at_us", F.unix_micros(F.col(ts).cast("timestamp")))
    rows = rows if idle else rows.withWatermark(ts, delay)
    before = initial
    if initial is not None:
        before = initial.select(
            F.col(key), F.unix_micros("session_start").alias("first_us"), F.unix_micros("last_hit").alias("last_us"),
            F.col("session_length").alias("n"), F.col("clickstream").alias("clicks"),
        ).groupBy(key)
    answers = rows.groupBy(key).transformWithState(
        statefulProcessor=SessionProcessor(seq, item, gap_seconds, keep, each_hit, idle),
        outputStructType=f"key {kind}, seq BIGINT, first_us BIGINT, last_us BIGINT, n BIGINT, clicks ARRAY<STRING>, closed BOOLEAN",
        outputMode="Append",
        timeMode="ProcessingTime" if idle else "EventTime",
        initialState=before,
    )
    return answers.select(*session_columns(key), "seq", "closed")


def open_sessions(spark: SparkSession, checkpoint: str, key: str = "ip") -> DataFrame:
    """All sessions that a stream of ``session_updates`` holds open, read from its state store.

    The stream itself only writes what changed; this is asked for when it is wanted, also while the stream runs.
    """
    held = spark.read.format("statestore").option("stateVarName", "session").load(checkpoint)
    return held.select(F.col(f"key.{key}").alias("key"), "value.*").select(*session_columns(key))
