"""The jobs on live input.  Each starts and returns one streaming query.

``checkpoint`` is the query's own folder; what a job carries between batches lies below ``state``.
Without an ``interval`` a query takes what is there and ends.  Jobs over sliding windows return their
sink too; ``close`` puts out the windows that were still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.access_log import FAILURE, SUCCESS
from millrace.functions.text import text_length
from millrace.functions.vectors import parse_labeled, parse_vector
from millrace.operators import kmeans, logs, running, sliding, words
from millrace.streaming import counts, learning, sinks, windows
from millrace.streaming.runner import for_each_batch, run_until, to_console
from millrace.streaming.sessions import SessionBatches, session_updates

#: A query over windows, and what puts out the last windows once it has ended: ``close(spark)``.
Windows = tuple[StreamingQuery, counts.TopWindows | windows.AlarmBatches]


def print_posts(posts: DataFrame, checkpoint: str, interval: str | None = "1 second") -> StreamingQuery:
    """Text of each incoming post, first ten per batch."""
    return to_console(posts.select("text"), checkpoint, interval, rows=10)


def save_posts(
    posts: DataFrame,
    out: str,
    checkpoint: str,
    limit: int | None = 1000,
    interval: str | None = "1 second",
    files: int | None = None,
) -> tuple[StreamingQuery, sinks.TextBatches]:
    """Post texts, a folder per non-empty batch.  See ``save_until`` for stopping at the limit."""
    sink = sinks.TextBatches(out, "text", limit, files)
    return for_each_batch(posts.select("text"), sink, checkpoint, interval), sink


def save_until(posts: DataFrame, out: str, checkpoint: str, limit: int = 1000, interval: str | None = "1 second"):
    """Save posts and stop the query once more than ``limit`` are written."""
    query, sink = save_posts(posts, out, checkpoint, limit, interval)
    run_until(query, lambda: sink.reached)


def post_lengths(posts: DataFrame, out: str, checkpoint: str, interval: str | None = "1 second") -> StreamingQuery:
    """Running count, characters, integer average and maxima, a row per non-empty batch."""
    lengths = posts.select(text_length(F.col("text")).alias("length"))
    return for_each_batch(lengths, sinks.RunningLengths(out), checkpoint, interval)


def post_totals(posts: DataFrame) -> DataFrame:
    """The same totals as a streaming aggregate of one row, for complete mode."""
    return running.total_lengths(posts)


def _top(rows: DataFrame, by: str, ts: str, window: int, state: str, out: str, checkpoint: str, interval, delay, k):
    late = counts.late_to(f"{state.rstrip('/')}/late")
    sink = counts.TopWindows(checkpoint, sinks.ParquetBatches(out), by, k=k, window=window, delay=delay, late=late)
    return for_each_batch(sink.stretches(rows, ts), sink, checkpoint, interval), sink


def popular_terms(
    posts: DataFrame, state: str, out: str, checkpoint: str, prefix: str = "$", window: int = 600, k: int = 10,
    interval: str | None = "1 second", delay: int = 10,
) -> Windows:
    return _top(words.terms(posts, prefix), "term", "ts", window, state, out, checkpoint, interval, delay, k)


def top_urls(
    lines: DataFrame, state: str, out: str, checkpoint: str, arrived: str = "arrived", window: int = 300, k: int = 10,
    interval: str | None = "1 second", delay: int = 10,
) -> Windows:
    return _top(logs.url_requests(lines), "url", arrived, window, state, out, checkpoint, interval, delay, k)


def top_fields(
    lines: DataFrame, field: str, state: str, out: str, checkpoint: str, arrived: str = "arrived", window: int = 300,
    k: int = 10, interval: str | None = "1 second", delay: int = 10,
) -> Windows:
    """Top ``agent`` or ``referer`` values."""
    rows = logs.field_or_marker(lines, field)
    return _top(rows, field, arrived, window, state, out, checkpoint, interval, delay, k)


def watch_errors(
    lines: DataFrame, state: str, status_out: str, alarm_out: str, checkpoint: str, arrived: str = "arrived",
    interval: str | None = "1 second", delay: int = 10, ticks: DataFrame | None = None, **settings,
) -> Windows:
    """Window status and alarms.

    Event time stands still while no line arrives; ``ticks`` (a stream with a ``ts`` column, see
    ``sources.lines.heartbeat``) move it on, so that silence is noticed.
    """
    rows = logs.classified_lines(lines).select(F.col(arrived).alias("at"), "status_class")
    if ticks is not None:
        rows = rows.unionByName(ticks.select(F.col("ts").alias("at"), F.lit(None).cast("string").alias("status_class")))
    kind: Column = F.col("status_class")
    measures = {
        "success": F.when(kind == SUCCESS, 1).otherwise(0),
        "failure": F.when(kind == FAILURE, 1).otherwise(0),
    }
    steps = windows.step_rows(rows, [], "at", measures=measures, counted=kind.isNotNull())
    sink = windows.AlarmBatches(
        state, sinks.ParquetBatches(status_out), sinks.ParquetBatches(alarm_out), delay=delay, **settings
    )
    return for_each_batch(steps, sink, checkpoint, interval), sink


def requests_to_sql(
    lines: DataFrame, out: str, export: str, checkpoint: str, interval: str | None = "1 second", show: bool = False,
    sql: str = "SELECT agent, count(*) AS total FROM requests GROUP BY agent",
) -> StreamingQuery:
    """Records of each batch as JSON, and a SQL answer over each batch."""
    records = logs.request_records(lines).select("url", "status", "agent")
    return for_each_batch(records, sinks.SqlBatches(sql, "requests", out, export, show), checkpoint, interval)


def visitor_sessions(
    hits: DataFrame, state: str, closed_out: str, open_out: str, checkpoint: str, interval: str | None = "1 second",
    show: bool = False, **settings,
) -> StreamingQuery:
    """Closed sessions, and after every batch all that are open, which can also be asked in SQL and shown."""
    snapshot = sinks.SqlBatches("SELECT * FROM sessionData", "sessionData", open_out, show=show)
    sink = SessionBatches(state, sinks.ParquetBatches(closed_out), snapshot, **settings)
    return for_each_batch(hits, sink, checkpoint, interval)


def visitor_updates(hits: DataFrame, **settings) -> DataFrame:
    """The session after every hit, as a streaming frame."""
    return session_updates(hits, **settings)


def status_windows(lines: DataFrame, width: str = "1 hour", delay: str | None = None) -> DataFrame:
    """Requests per status and event-time window in window order, for complete mode.

    With a ``delay`` for append mode instead: each window once, when the watermark has passed its end, in no order.  State then holds only open
    windows; lines that come later than that are dropped and counted (``runner.late_rows``).
    """
    parsed = logs.parse_access_log(lines, "drop", fields=["ts", "status"])
    if delay is None:
        return sliding.tumbling_counts(parsed, ["status"], "ts", width).orderBy("window", "status")
    return sliding.tumbling_counts(parsed.withWatermark("ts", delay), ["status"], "ts", width)


def train_kmeans(
    lines: DataFrame, model: str, checkpoint: str, start: kmeans.KMeansModel, decay: float = 1.0,
    interval: str | None = "1 second", keep: int | None = None,
) -> StreamingQuery:
    """Centres learnt from lines ``[a,b]``; lines that are no such vector are counted beside the model.

    ``keep`` bounds the versions kept; without it every one stays, so that scoring by a named version goes on.
    """
    vectors = lines.select(parse_vector(F.col("line")).alias("features"))
    return for_each_batch(vectors, learning.KMeansTrainer(model, start, decay, keep=keep), checkpoint, interval)


def score_kmeans(
    lines: DataFrame, model: str, out: str, checkpoint: str, start: kmeans.KMeansModel, version: int | None = None,
    interval: str | None = "1 second", behind: bool = False,
) -> StreamingQuery:
    """Label and cluster of lines ``(label,[a,b])``; ``behind``: see ``learning.Scorer``."""
    labelled = lines.select(parse_labeled(F.col("line")).alias("p")).select("p.*")
    sink = learning.kmeans_scorer(model, start, sinks.ParquetBatches(out), version, behind)
    return for_each_batch(labelled, sink, checkpoint, interval)


def _points(lines: DataFrame) -> DataFrame:
    parsed = lines.select(parse_labeled(F.col("line")).alias("p"))
    return parsed.select(F.col("p.label").alias("label"), F.get("p.features", F.lit(0)).alias("feature"))


def train_line(
    lines: DataFrame, model: str, checkpoint: str, carry_intercept: bool = False, interval: str | None = "1 second",
    keep: int | None = None,
) -> StreamingQuery:
    """A line learnt from lines ``label,feature``; lines that are not are counted beside the model."""
    trainer = learning.LineTrainer(model, carry_intercept=carry_intercept, keep=keep)
    return for_each_batch(_points(lines), trainer, checkpoint, interval)


def score_line(
    lines: DataFrame, model: str, out: str, checkpoint: str, version: int | None = None,
    interval: str | None = "1 second", behind: bool = False,
) -> StreamingQuery:
    """Label and prediction of lines ``label,feature``; ``behind``: see ``learning.Scorer``."""
    sink = learning.line_scorer(model, sinks.ParquetBatches(out), version, out, behind)
    return for_each_batch(_points(lines), sink, checkpoint, interval)
