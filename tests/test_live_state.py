"""Streams that keep their state in Spark's state store: timers, history taken over, snapshots, bounded windows, stopping."""

import os
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import sessions
from millrace.plans.resumed_queries import parts_by
from millrace.plans.stream_queries import PARTS, arriving_events
from millrace.sources import derived, posts
from millrace.streaming import jobs, runner, sinks
from millrace.streaming.sessions import open_sessions
from millrace.streaming.silence import silences

BASE = 1_704_067_200
HITS = "event_id BIGINT, ip STRING, at BIGINT, url STRING"


def add(spark, folder, rows, schema):
    """One more file, later than the ones before."""
    os.makedirs(folder, exist_ok=True)
    number = len(os.listdir(folder))
    frame = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds(F.col("at") + BASE))
    frame.toPandas().to_parquet(f"{folder}/{number}.parquet", coerce_timestamps="us")
    os.utime(f"{folder}/{number}.parquet", (1_700_000_000 + 10 * number,) * 2)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema.replace("at BIGINT", "at TIMESTAMP")).option("maxFilesPerTrigger", 1).parquet(folder)


def hits_of(rows):
    """Answers of an each-hit stream."""
    return sorted((r["ip"], r["seq"], int(r["session_start"].timestamp()) - BASE, r["session_length"], tuple(r["clickstream"])) for r in rows)


def each_hit(rows, gap):
    out, state = [], {}
    for seq, ip, at, url in sorted(rows, key=lambda r: (r[2], r[0])):
        first, last, n, clicks = state.get(ip, (None, None, 0, ()))
        if last is None or at - last > gap:
            first, n, clicks = at, 0, ()
        state[ip] = (first, at, n + 1, (*clicks, url)[:10])
        out.append((ip, seq, first, n + 1, state[ip][3]))
    return sorted(out)


def wait_for(found, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if (rows := found()):
            return rows
        time.sleep(0.5)
    raise AssertionError("nothing came")


def read(spark, folder):
    names = os.listdir(folder) if os.path.exists(folder) else []
    done = [f"{folder}/{n}" for n in names if os.path.exists(f"{folder}/{n}/_SUCCESS")]
    return spark.read.parquet(*done).collect() if done else []


def test_session_ends_by_the_clock_without_input(spark, tmp_path):
    """The hits' own times are hours apart; only the clock counts, and nothing comes after them."""
    add(spark, f"{tmp_path}/in", [(1, "v", 0, "/a"), (2, "v", 50_000, "/b"), (3, "w", 7, "/c")], HITS)
    frame = jobs.visitor_updates(stream(spark, f"{tmp_path}/in", HITS), ts="at", seq="event_id", gap_seconds=3, idle=True)
    query = runner.for_each_batch(frame, sinks.ParquetBatches(f"{tmp_path}/out"), f"{tmp_path}/cp", "500 milliseconds")
    try:
        closed = wait_for(lambda: rows if len(rows := [r for r in read(spark, f"{tmp_path}/out") if r["closed"]]) == 2 else None)
        assert sorted((r["ip"], r["session_length"], tuple(r["clickstream"])) for r in closed) == [("v", 2, ("/a", "/b")), ("w", 1, ("/c",))]
    finally:
        query.stop()
    assert open_sessions(spark, f"{tmp_path}/cp").count() == 0


def test_silence_is_noticed_by_the_clock_without_input(spark, tmp_path):
    add(spark, f"{tmp_path}/in", [(1, "v", 0, "/a")], HITS)
    frame = silences(stream(spark, f"{tmp_path}/in", HITS), "at", window=2, max_silence=1, clock=True)
    begin = int(time.time())
    query = runner.for_each_batch(frame, sinks.ParquetBatches(f"{tmp_path}/out"), f"{tmp_path}/cp", "500 milliseconds")
    try:
        rows = wait_for(lambda: read(spark, f"{tmp_path}/out"))
        first = min(r["from_t"] for r in rows)
        assert begin + 4 <= first <= time.time() and all(r["key"] == "rows" and r["from_t"] < r["until_t"] for r in rows)
    finally:
        query.stop()


@pytest.mark.parametrize("parts", [[[0, 5, 400, 1000, 1001]], [[0, 5], [400], [1000, 1001]], [[0, 400], [5, 1000], [1001, 1500]]])
def test_silence_in_event_time(spark, tmp_path, parts):
    """Stretches are the same however the rows are cut into batches; a row that fills a gap in time is no surprise."""
    for part in parts:
        add(spark, f"{tmp_path}/in", [(i, "v", at, "/") for i, at in enumerate(part)], HITS)
    frame = silences(stream(spark, f"{tmp_path}/in", HITS), "at", window=100, max_silence=30, delay=400 if 1500 in parts[-1] else 0)
    runner.for_each_batch(frame, sinks.ParquetBatches(f"{tmp_path}/out"), f"{tmp_path}/cp", None).awaitTermination()
    got = {t - BASE for r in read(spark, f"{tmp_path}/out") for t in range(r["from_t"], r["until_t"])}
    until = 1500 - 400 if 1500 in parts[-1] else 1001
    assert got == {*range(5 + 131, 401), *range(400 + 131, 1001)} and max(got) <= until


def test_stream_takes_over_from_history(spark, tmp_path):
    rows = [(i, "abc"[i % 3], at, f"/{i}") for i, at in enumerate([0, 3, 5, 40, 60, 90, 91, 95, 100, 180, 185, 190, 300, 301])]
    history = spark.createDataFrame(rows[:7], HITS).withColumn("at", F.timestamp_seconds(F.col("at") + BASE))
    found = sessions.sessions(history, "ip", "at", "event_id", "url", 50)
    initial = sessions.session_snapshot(found, "ip", 50)
    for number, part in enumerate((rows[7:10], rows[10:])):
        add(spark, f"{tmp_path}/in", part, HITS)
        frame = jobs.visitor_updates(
            stream(spark, f"{tmp_path}/in", HITS), ts="at", seq="event_id", gap_seconds=50, delay="0 seconds", initial=initial
        )
        runner.for_each_batch(frame, sinks.ParquetBatches(f"{tmp_path}/out"), f"{tmp_path}/cp", None).awaitTermination()
    got = hits_of(r for r in read(spark, f"{tmp_path}/out") if not r["closed"])
    assert got == [r for r in each_hit(rows, 50) if r[1] >= 7]


def test_snapshot_comes_from_the_state_and_batches_write_what_changed(spark, events, tmp_path):
    stored = events.withColumn("ts", F.col("ts").cast("timestamp"))
    sizes = []
    for part in parts_by(stored, F.unix_micros("ts")):
        part.write.mode("append").parquet(f"{tmp_path}/in")
        frame = jobs.visitor_updates(
            spark.readStream.schema(part.schema).parquet(f"{tmp_path}/in"), key="user_id", kind="BIGINT", seq="event_id", item="event_type",
            gap_seconds=30 * 86_400, each_hit=False, delay="0 seconds",
        )
        runner.for_each_batch(frame, sinks.ParquetBatches(f"{tmp_path}/out"), f"{tmp_path}/cp", None).awaitTermination()
        sizes.append(part.select("user_id").distinct().count())
    wanted = sessions.sessions(events, "user_id", "ts", "event_id", "event_type", 30 * 86_400)
    columns = ["user_id", "session_start", "last_hit", "session_length", "clickstream"]
    got = open_sessions(spark, f"{tmp_path}/cp", "user_id")
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, wanted.select(columns).collect()))
    written = spark.read.parquet(f"{tmp_path}/out").groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in written if r["count"]) == sorted(sizes)


def test_closed_windows_leave_the_state(spark, tmp_path):
    line = '1.1.1.1 - - [01/Jan/2024:{}:{:02d}:00 +0000] "GET / HTTP/1.1" 200 1 "-" "a"'
    os.makedirs(f"{tmp_path}/in")
    for number, hour in enumerate(["00", "01", "02", "03", "00"]):
        with open(f"{tmp_path}/in/{number}.txt", "w") as f:
            f.writelines(line.format(hour, minute) + "\n" for minute in range(60))
        os.utime(f"{tmp_path}/in/{number}.txt", (1_700_000_000 + 10 * number,) * 2)
    source = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_path}/in").withColumnRenamed("value", "line")
    frame = jobs.status_windows(source, "10 minutes", "10 minutes")
    query = runner.for_each_batch(frame, sinks.ParquetBatches(f"{tmp_path}/out"), f"{tmp_path}/cp", None)
    query.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    ends = sorted(r["window"]["end"].timestamp() - BASE for r in out.collect())
    assert ends == [600.0 * i for i in range(1, 23)] and {r["n"] for r in out.collect()} == {10}
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(states) <= 12 and states[-1] <= 2
    assert runner.late_rows(query) > 0  # the last file came hours late


@pytest.mark.parametrize("files", [1, 7, 12])
def test_batches_do_not_grow_with_files(spark, tmp_path, files):
    """Parts that many tasks wrote come as whole batches, read by several tasks, and no row is late."""
    day = F.timestamp_seconds(F.lit(BASE) + F.col("id") * 7200).cast("timestamp_ntz")
    rows = spark.range(0, 360, 1, files).select(
        F.col("id").alias("event_id"), day.alias("ts"), (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type")
    )
    rows.repartition(files).write.parquet(f"{tmp_path}/events.parquet")
    stream, late = arriving_events(spark, str(tmp_path))
    batches = []
    frame = derived.access_log(stream)
    runner.for_each_batch(frame, lambda batch, i: batches.append((batch.count(), batch.rdd.getNumPartitions())), f"{tmp_path}/cp", None).awaitTermination()
    assert len(batches) <= PARTS and sum(n for n, _ in batches) == 360
    assert files == 1 or all(tasks > 1 for _, tasks in batches)
    query = runner.for_each_batch(
        jobs.status_windows(frame, "10 minutes", f"{late} seconds"), sinks.ParquetBatches(f"{tmp_path}/out"), f"{tmp_path}/cp-windows", None
    )
    query.awaitTermination()
    assert runner.late_rows(query) == 0
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.sum("n")).first()[0] > 0


def test_saver_stops_after_the_batch_that_passes_the_bound(spark, events, tmp_path):
    for part in parts_by(derived.posts(events).coalesce(1), F.col("id")):
        part.write.mode("append").json(f"{tmp_path}/in")
    source = posts.stream_posts(spark, f"{tmp_path}/in", max_files_per_trigger=1)
    begin = time.time()
    jobs.save_until(source, f"{tmp_path}/out", f"{tmp_path}/cp", limit=300, interval="100 milliseconds")
    assert spark.read.text(f"{tmp_path}/out").select("batch_id").distinct().count() == 2 and time.time() - begin < 60
