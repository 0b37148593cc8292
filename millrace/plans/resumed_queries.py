"""Registered queries of streams that stop and go on: each part of a table arrives, is taken by a run that resumes from the checkpoint, and the next follows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import sessions
from millrace.operators.sliding import every_slide
from millrace.plans.registry import DAY_GAP, first_centres, flat_sessions, flat_windows, query
from millrace.plans.stream_queries import PARTS, arriving_events, batches, written_parts
from millrace.session import scratch_path, use_rocksdb_state
from millrace.sources import derived, feed, lines, posts
from millrace.streaming import jobs, learning
from millrace.streaming.runner import for_each_batch
from millrace.streaming.sessions import open_sessions
from millrace.streaming.silence import silences
from millrace.streaming.sinks import ParquetBatches

#: Weight of old batches in the training queries.
DECAY = 0.5


def parts_by(df: DataFrame, number: Column) -> Iterator[DataFrame]:
    """The rows in ``PARTS`` spans of a numeric column, one after the other."""
    numbered = df.withColumn("_at", number)
    first, last = numbered.agg(F.min("_at"), F.max("_at")).first()
    part = F.expr(f"(_at - {first}) * {PARTS} div ({last} - {first} + 1)")
    for i in range(PARTS):
        yield numbered.where(part == i).drop("_at")


def moment() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def event_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[DataFrame]]:
    events = derived.table(use_rocksdb_state(spark), sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events, list(parts_by(events, moment()))


def run_parts(spark: SparkSession, parts: list[DataFrame], folder: str, start: Callable[[DataFrame], object]) -> None:
    """Each part is written and taken by a run of its own, as one batch however many files it has."""
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        start(spark.readStream.schema(part.schema).parquet(f"{folder}/in")).awaitTermination()


def user_updates(hits: DataFrame, delay: str, **settings) -> DataFrame:
    return jobs.visitor_updates(
        hits, key="user_id", kind="BIGINT", seq="event_id", item="event_type", gap_seconds=DAY_GAP, delay=delay, **settings
    )


@query
def stream_session_hits(spark, sf_dir):
    """The session after every hit: the first half of the events is stored history, the second half comes live and takes over."""
    folder = scratch_path(spark, "session-hits")
    events, parts = event_parts(spark, sf_dir)
    found = sessions.sessions(parts[0].unionByName(parts[1]), "user_id", "ts", "event_id", "event_type", DAY_GAP)
    history = sessions.session_snapshot(found, "user_id", DAY_GAP)

    def start(hits: DataFrame):
        return for_each_batch(user_updates(hits, "0 seconds", initial=history), ParquetBatches(f"{folder}/out"), f"{folder}/cp", None)

    run_parts(spark, parts[2:], folder, start)
    hits = batches(spark, f"{folder}/out").where("NOT closed")
    return flat_sessions(hits, "user_id", "seq").withColumnRenamed("seq", "event_id")


@query
def stream_session_snapshot(spark, sf_dir):
    """The sessions still open when the stream has taken all events, read from its state store."""
    folder = scratch_path(spark, "session-snapshot")
    _, parts = event_parts(spark, sf_dir)

    def start(hits: DataFrame):
        return for_each_batch(user_updates(hits, "0 seconds", each_hit=False), ParquetBatches(f"{folder}/out"), f"{folder}/cp", None)

    run_parts(spark, parts, folder, start)
    return flat_sessions(open_sessions(spark, f"{folder}/cp", "user_id"), "user_id")


@query
def stream_closed_windows(spark, sf_dir):
    """Requests per status and window, put out once when the watermark has passed the window."""
    folder = scratch_path(spark, "closed-windows")
    events, late = arriving_events(spark, sf_dir)
    windows = jobs.status_windows(derived.access_log(events), "10 minutes", f"{late} seconds")
    for_each_batch(windows, ParquetBatches(f"{folder}/out"), f"{folder}/cp", None).awaitTermination()
    return flat_windows(batches(spark, f"{folder}/out"))


@query
def stream_saved_until(spark, sf_dir):
    """Post texts of a stream that is stopped after the batch in which more than 1,000 posts are out."""
    folder = scratch_path(spark, "saved-until")
    stored = derived.posts(derived.table(use_rocksdb_state(spark), sf_dir, "events"))
    written_parts(stored.coalesce(1), "ts", f"{folder}/in", "json", file_rows=0)  # a file, and so a batch, per part
    jobs.save_until(posts.stream_posts(spark, f"{folder}/in", max_files_per_trigger=1), f"{folder}/out", f"{folder}/cp", 1000, None)
    saved = spark.read.text(f"{folder}/out").select(F.col("value").alias("text"))
    return saved.groupBy("text").agg(F.count("*").alias("n"))


@query
def stream_feed_posts(spark, sf_dir):
    """Every post of a feed that grows between four runs, each going on at the bytes where the one before stopped."""
    folder = scratch_path(spark, "feed")
    stored = derived.posts(derived.table(use_rocksdb_state(spark), sf_dir, "events"))
    for part in parts_by(stored, F.col("id")):
        part.write.mode("append").json(f"{folder}/in")
        found = feed.stream_feed(spark, f"{folder}/in")
        for_each_batch(found, ParquetBatches(f"{folder}/out"), f"{folder}/cp", None).awaitTermination()
    return batches(spark, f"{folder}/out").select("id", F.unix_seconds("ts").alias("at"), "text")


def trained_and_scored(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Each part goes to a training and a scoring stream that run side by side; part p is scored by what the parts before it taught."""
    start = first_centres(spark, sf_dir)
    table = derived.vectors(derived.table(use_rocksdb_state(spark), sf_dir, "embeddings"))
    for part in parts_by(table, F.col("vec_id")):
        vector = F.to_json("features")
        part.select(vector).write.mode("append").text(f"{folder}/train")
        part.select(F.concat(F.lit("("), "label", F.lit(","), vector, F.lit(")"))).write.mode("append").text(f"{folder}/test")
        training = jobs.train_kmeans(lines.stream_lines(spark, f"{folder}/train"), f"{folder}/model", f"{folder}/cp-train", start, DECAY, None)
        scoring = jobs.score_kmeans(
            lines.stream_lines(spark, f"{folder}/test"), f"{folder}/model", f"{folder}/out", f"{folder}/cp-score", start, interval=None, behind=True
        )
        training.awaitTermination()
        scoring.awaitTermination()


@query
def stream_train_and_score(spark, sf_dir):
    """How often labels met clusters while the centres were still being learnt."""
    folder = scratch_path(spark, "train-score")
    trained_and_scored(spark, sf_dir, folder)
    return batches(spark, f"{folder}/out").groupBy("label", "cluster").agg(F.count("*").alias("n"))


@query
def stream_kmeans_decay(spark, sf_dir):
    """The centres after four batches, old ones counting half in each, trained while scoring goes on."""
    folder = scratch_path(spark, "kmeans-decay")
    trained_and_scored(spark, sf_dir, folder)
    model = learning.KMeansStore(spark, f"{folder}/model").table.latest()
    spread = model.select(F.posexplode(F.arrays_zip("centres", "weights")).alias("cluster", "c"))
    return spread.select("cluster", F.round("c.weights", 6).alias("n"), F.posexplode("c.centres").alias("axis", "centre")).withColumn("centre", F.round("centre", 6))


@query
def stream_regression_batches(spark, sf_dir):
    """The line after four batches: the slope goes on from batch to batch, the intercept starts anew."""
    folder = scratch_path(spark, "line-batches")
    _, parts = event_parts(spark, sf_dir)

    def start(events: DataFrame):
        points = derived.labelled_points(events).select("label", "feature")
        return for_each_batch(points, learning.LineTrainer(f"{folder}/model"), f"{folder}/cp", None)

    run_parts(spark, parts, folder, start)
    line = learning.LineStore(spark, f"{folder}/model").table.latest()
    return line.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query
def stream_silences(spark, sf_dir):
    """Silent windows of the log with ten minutes cut out, found by timers while the parts arrive."""
    folder = scratch_path(spark, "silences")
    _, parts = event_parts(spark, sf_dir)

    def start(events: DataFrame):
        found = silences(derived.without_gap(derived.access_log(events)), "arrived")
        return for_each_batch(found, ParquetBatches(f"{folder}/out"), f"{folder}/cp", None)

    run_parts(spark, parts, folder, start)
    ends = every_slide(batches(spark, f"{folder}/out").select("from_t", "until_t"))
    return ends.select("window_end", F.lit("no_data").alias("kind"))
