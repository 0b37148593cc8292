"""Starting streaming queries, and the plain sinks."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

BatchFn = Callable[[DataFrame, int], None]


def _scheduled(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def for_each_batch(
    df: DataFrame, fn: BatchFn, checkpoint: str, interval: str | None = "1 second", mode: str = "append"
) -> StreamingQuery:
    """Hand every micro-batch and its id to ``fn``.  Without an interval: what is there now, then end."""
    return _scheduled(df.writeStream.outputMode(mode).foreachBatch(fn), checkpoint, interval).start()


def to_console(
    df: DataFrame, checkpoint: str, interval: str | None = "1 second", mode: str = "append", rows: int = 10
) -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = df.writeStream.outputMode(mode).format("console").option("numRows", rows).option("truncate", "false")
    return _scheduled(writer, checkpoint, interval).start()


def to_memory(
    df: DataFrame, name: str, checkpoint: str, interval: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Keep results as a table on the driver: for trials and tests on small data only."""
    writer = df.writeStream.outputMode(mode).format("memory").queryName(name)
    if mode == "append":  # the memory sink cannot resume in append mode
        writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
        return writer.start()
    return _scheduled(writer, checkpoint, interval).start()


class _Watch(StreamingQueryListener):
    """Wakes whoever waits when a batch of the query has brought what is waited for, or the query has ended."""

    def __init__(self, query: StreamingQuery, done: Callable[[], bool]):
        self.query_id, self.done, self.over = str(query.id), done, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query_id and self.done():
            self.over.set()

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.over.set()


def run_until(query: StreamingQuery, done: Callable[[], bool]) -> None:
    """Wait for the query to end by itself, or stop it after the batch that makes ``done`` true."""
    streams = SparkSession.active().streams
    watch = _Watch(query, done)
    streams.addListener(watch)
    try:
        # it may have come that far before it was watched, and an event may be lost: hence the look once a second
        while query.isActive and not done() and not watch.over.wait(1):
            pass
    finally:
        streams.removeListener(watch)
    if query.isActive:
        query.stop()  # a stopped query is not awaited: its thread may have been cut off in the middle of a batch
    else:
        query.awaitTermination()  # raises what it failed with


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped, by the progress that is still kept."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
