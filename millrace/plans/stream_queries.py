"""Registered queries that run as streams over the stored events, once, and read back the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import running
from millrace.plans.registry import (
    DAY_GAP,
    LOW_RATIO,
    first_centres,
    flat_sessions,
    flat_windows,
    query,
)
from millrace.session import scratch_path, use_rocksdb_state
from millrace.sources import derived, lines, posts
from millrace.streaming import jobs, learning, sinks
from millrace.streaming.runner import for_each_batch
from millrace.streaming.versions import VersionedTable


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table as a stream.  All files there make one batch, so no row can come late.

    The file source wants a folder or a pattern; the pattern here fits a single file and a folder.
    """
    schema = derived.table(use_rocksdb_state(spark), sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_stream(spark, sf_dir, "events")


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.access_log(event_stream(spark, sf_dir))


PARTS = 4


#: Rows of a file of a part: a Parquet file of one row group is read by one task, so a part has to be many files.
FILE_ROWS = 100_000


def written_parts(df: DataFrame, ts: str, folder: str, fmt: str = "parquet", file_rows: int = FILE_ROWS) -> int:
    """The rows in time order, written part after part; gives the seconds that a part spans.

    Files are read in the order in which they were written.  A part may be many files, so rows come late by the
    span of a part at most.  ``file_rows`` 0 leaves a file per task.
    """
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    first, last = df.agg(F.min(at), F.max(at)).first()
    span = (last - first) // PARTS + 1
    for i in range(PARTS):
        piece = df.where((at >= first + i * span) & (at < first + (i + 1) * span))
        piece.write.mode("append").option("maxRecordsPerFile", file_rows).format(fmt).save(folder)
    return span


def files_per_batch(spark: SparkSession, folder: str) -> int:
    """So many files that a stream takes the folder in ``PARTS`` batches at most, however many tasks wrote it.

    With a file per batch the batches would grow with the input, and a file that cannot be split would leave all cores but one idle.
    """
    files = len(spark.read.text(folder).inputFiles())
    return max(1, -(-files // PARTS))


def arriving_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The stored events as a stream of several batches in time order, and how late rows may come (in log time)."""
    table = derived.table(use_rocksdb_state(spark), sf_dir, "events")
    folder = scratch_path(spark, "arriving")
    span = written_parts(table, "ts", folder)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch(spark, folder)).parquet(folder)
    return stream, span // derived.SQUEEZE + 2


def newest_result(df: DataFrame, folder: str) -> DataFrame:
    """Run a complete-mode stream to its end and read its last answer."""
    spark = df.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    table = VersionedTable(spark, f"{folder}/result", schema)
    for_each_batch(df, lambda batch, i: table.write(i, batch), f"{folder}/checkpoint", None, "complete").awaitTermination()
    return table.latest()


def batches(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("batch_id")


def ended(spark: SparkSession, running_query, sink) -> None:
    """Waits for the end of a bounded run and has its last windows put out."""
    running_query.awaitTermination()
    sink.close(spark)


@query
def stream_status_by_window(spark, sf_dir):
    windows = jobs.status_windows(log_stream(spark, sf_dir), "10 minutes")
    flat = flat_windows(windows)
    return newest_result(flat, scratch_path(spark, "status"))


@query
def stream_total_lengths(spark, sf_dir):
    totals = running.total_lengths(derived.posts(event_stream(spark, sf_dir)))
    return newest_result(totals, scratch_path(spark, "totals"))


@query
def stream_top_urls(spark, sf_dir):
    folder = scratch_path(spark, "top-urls")
    events, late = arriving_events(spark, sf_dir)
    out = f"{folder}/out"
    run = jobs.top_urls(derived.access_log(events), f"{folder}/state", out, f"{folder}/cp", interval=None, delay=late)
    ended(spark, *run)
    return batches(spark, out)


@query
def stream_trending_terms(spark, sf_dir):
    folder = scratch_path(spark, "terms")
    events, late = arriving_events(spark, sf_dir)
    out = f"{folder}/out"
    run = jobs.popular_terms(derived.posts(events), f"{folder}/state", out, f"{folder}/cp", interval=None, delay=late)
    ended(spark, *run)
    return batches(spark, out)


def streamed_alarms(spark: SparkSession, lines: DataFrame, late: int) -> DataFrame:
    folder = scratch_path(spark, "alarms")
    out = f"{folder}/alarms"
    run = jobs.watch_errors(
        lines, f"{folder}/state", f"{folder}/status", out, f"{folder}/cp", interval=None, delay=late, max_ratio=LOW_RATIO
    )
    ended(spark, *run)
    return batches(spark, out)


@query
def stream_alarm_log(spark, sf_dir):
    events, late = arriving_events(spark, sf_dir)
    return streamed_alarms(spark, derived.access_log(events), late)


@query
def stream_alarm_log_with_silence(spark, sf_dir):
    """Over a log with ten silent minutes cut out, which is what the no-data alarm is for."""
    events, late = arriving_events(spark, sf_dir)
    return streamed_alarms(spark, derived.without_gap(derived.access_log(events)), late)


@query
def stream_top_agents(spark, sf_dir):
    folder = scratch_path(spark, "top-agents")
    events, late = arriving_events(spark, sf_dir)
    lines, out = derived.access_log(events), f"{folder}/out"
    run = jobs.top_fields(lines, "agent", f"{folder}/state", out, f"{folder}/cp", k=3, interval=None, delay=late)
    ended(spark, *run)
    return batches(spark, out)


@query
def stream_text_status(spark, sf_dir):
    """Requests per status and window out of lines of text files, several batches."""
    folder = scratch_path(spark, "text-status")
    stored = derived.access_log(derived.table(use_rocksdb_state(spark), sf_dir, "events"))
    stored.select("line").write.text(f"{folder}/in")
    streamed = lines.stream_lines(spark, f"{folder}/in", files_per_batch(spark, f"{folder}/in"))
    windows = jobs.status_windows(streamed, "10 minutes")
    return newest_result(flat_windows(windows), folder)


def json_posts(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The posts as a stream of JSON files in time order."""
    stored = derived.posts(derived.table(use_rocksdb_state(spark), sf_dir, "events"))
    written_parts(stored, "ts", f"{folder}/in", "json")
    return posts.stream_posts(spark, f"{folder}/in", max_files_per_trigger=files_per_batch(spark, f"{folder}/in"))


@query
def stream_json_lengths(spark, sf_dir):
    """The last of the running totals over JSON posts that come in several batches."""
    folder = scratch_path(spark, "json-lengths")
    jobs.post_lengths(json_posts(spark, sf_dir, folder), f"{folder}/out", f"{folder}/cp", None).awaitTermination()
    rows = spark.read.parquet(f"{folder}/out")
    last = rows.agg(F.max_by(F.struct("total_posts", "total_chars", "max_so_far", "average"), "batch_id").alias("r"))
    return last.select("r.*")


@query
def stream_kmeans_scores(spark, sf_dir):
    """How often labels of lines ``(label,[..])`` meet the clusters of the starting centres, scored live."""
    folder = scratch_path(spark, "scores")
    table = derived.vectors(derived.table(spark, sf_dir, "embeddings"))
    table.select(F.concat(F.lit("("), "label", F.lit(","), F.to_json("features"), F.lit(")"))).write.text(f"{folder}/in")
    scored = jobs.score_kmeans(
        lines.stream_lines(spark, f"{folder}/in"), f"{folder}/model", f"{folder}/out", f"{folder}/cp",
        first_centres(spark, sf_dir), interval=None,
    )
    scored.awaitTermination()
    return batches(spark, f"{folder}/out").groupBy("label", "cluster").agg(F.count("*").alias("n"))


@query
def stream_agent_counts(spark, sf_dir):
    folder = scratch_path(spark, "agents")
    out = f"{folder}/out"
    jobs.requests_to_sql(
        log_stream(spark, sf_dir), out, f"{folder}/json", f"{folder}/cp", interval=None
    ).awaitTermination()
    return batches(spark, out)


@query
def stream_sessions(spark, sf_dir):
    folder = scratch_path(spark, "sessions")
    jobs.visitor_sessions(
        event_stream(spark, sf_dir), f"{folder}/state", f"{folder}/closed", f"{folder}/open", f"{folder}/cp",
        interval=None, key="user_id", kind="BIGINT", ts="ts", seq="event_id", item="event_type", gap_seconds=DAY_GAP,
    ).awaitTermination()
    found = batches(spark, f"{folder}/closed").unionByName(batches(spark, f"{folder}/open"))
    return flat_sessions(found, "user_id")


@query
def stream_kmeans(spark, sf_dir):
    """The model a training stream leaves, one row per centre and axis."""
    folder = scratch_path(spark, "kmeans")
    stream = derived.vectors(table_stream(spark, sf_dir, "embeddings"))
    trainer = learning.KMeansTrainer(f"{folder}/model", first_centres(spark, sf_dir))
    for_each_batch(stream.select("features"), trainer, f"{folder}/cp", None).awaitTermination()
    model = learning.KMeansStore(spark, f"{folder}/model").table.latest()
    spread = model.select(F.posexplode(F.arrays_zip("centres", "weights")).alias("cluster", "c"))
    return spread.select(
        "cluster", F.col("c.weights").cast("bigint").alias("n"), F.posexplode("c.centres").alias("axis", "centre")
    ).withColumn("centre", F.round("centre", 6))


@query
def stream_regression(spark, sf_dir):
    folder = scratch_path(spark, "line")
    stream = derived.labelled_points(event_stream(spark, sf_dir)).select("label", "feature")
    trainer = learning.LineTrainer(f"{folder}/model")
    for_each_batch(stream, trainer, f"{folder}/cp", None).awaitTermination()
    line = learning.LineStore(spark, f"{folder}/model").table.latest()
    return line.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query
def stream_saved_posts(spark, sf_dir):
    """Post texts as saved by a stream without a bound."""
    folder = scratch_path(spark, "saved")
    stream = derived.posts(event_stream(spark, sf_dir))
    query_, _ = jobs.save_posts(stream, f"{folder}/out", f"{folder}/cp", limit=None, interval=None)
    query_.awaitTermination()
    saved = spark.read.text(f"{folder}/out").select(F.col("value").alias("text"))
    return saved.groupBy("text").agg(F.count("*").alias("n"))
