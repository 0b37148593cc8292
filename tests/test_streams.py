import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from millrace.operators import alarms, kmeans, logs, regression, running, sessions, sliding, words
from millrace.session import passing_scratch
from millrace.sources import derived, lines, posts
from millrace.streaming import counts, jobs, learning, runner, sinks, windows
from millrace.streaming.sessions import SessionBatches
from millrace.streaming.versions import VersionedTable

PARTS = 4


def write_parts(df, order, folder, fmt, parts=PARTS):
    """The rows in time order, as one file per part, each later than the one before."""
    os.makedirs(folder)
    bounds = df.agg(F.min(order).cast("double"), F.max(order).cast("double")).first()
    step = (bounds[1] - bounds[0]) / parts
    for i in range(parts):
        at = F.col(order).cast("double")
        low, high = bounds[0] + i * step, bounds[0] + (i + 1) * step
        piece = df.where((at >= low) & ((at < high) | F.lit(i == parts - 1)))
        piece.coalesce(1).write.format(fmt).save(f"{folder}/.tmp{i}")
        name = next(f for f in os.listdir(f"{folder}/.tmp{i}") if f.startswith("part-"))
        shutil.copy(f"{folder}/.tmp{i}/{name}", f"{folder}/{i}.{fmt}")
        os.utime(f"{folder}/{i}.{fmt}", (1_700_000_000 + 10 * i,) * 2)
    return folder


@pytest.fixture(scope="module")
def log(events):
    return derived.access_log(events)


@pytest.fixture(scope="module")
def folders(spark, events, log, tmp_path_factory):
    base = tmp_path_factory.mktemp("in")
    made = {
        "log": write_parts(log, "arrived", f"{base}/log", "parquet"),
        "gap": write_parts(derived.without_gap(log), "arrived", f"{base}/gap", "parquet"),
        "posts": write_parts(derived.posts(events), "ts", f"{base}/posts", "json"),
        "events": write_parts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", f"{base}/events", "parquet"),
    }
    ordered = log.orderBy("event_id").select("line")
    made["text"] = f"{base}/text"
    rows = [r["line"] for r in ordered.collect()]
    os.makedirs(made["text"])
    for i in range(PARTS):
        with open(f"{made['text']}/{i}.txt", "w") as f:
            f.writelines(f"{line}\n" for line in rows[i::PARTS])
    return made


LOG_SCHEMA = "event_id BIGINT, arrived TIMESTAMP, line STRING"
EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def stream(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
    return query


def in_two_runs(folder, tmp_path, start, end=finish):
    """Run over half of the files, add the others, and resume from the checkpoint."""
    growing = f"{tmp_path}/growing"
    os.makedirs(growing)
    names = sorted(n for n in os.listdir(folder) if not n.startswith("."))
    for part in (names[: len(names) // 2], names[len(names) // 2 :]):
        for name in part:
            shutil.copy2(f"{folder}/{name}", growing)
        end(start(growing))


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def finish_windows(spark, run):
    query, sink = run
    finish(query)
    sink.close(spark)
    sink.close(spark)  # closing again changes nothing


def test_status_windows_text_source(spark, folders, log, tmp_path):
    frame = jobs.status_windows(lines.stream_lines(spark, folders["text"], 1), "10 minutes")
    finish(runner.to_memory(frame, "status", f"{tmp_path}/cp", mode="complete"))
    got = spark.table("status")
    wanted = sliding.tumbling_counts(logs.parse_access_log(log, "drop"), ["status"], "ts", "10 minutes")
    assert rows_of(got) == rows_of(wanted)
    assert lines.read_lines(spark, folders["text"]).count() == log.count()


def test_top_urls_resumes(spark, folders, log, tmp_path):
    def start(folder):
        return jobs.top_urls(
            stream(spark, folder, LOG_SCHEMA), f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/cp",
            k=2, interval=None, delay=0,
        )

    in_two_runs(folders["log"], tmp_path, start, lambda run: finish_windows(spark, run))
    urls = logs.url_requests(log)
    wanted = sliding.top_k_sliding(urls, ["url"], "arrived", k=2)
    assert rows_of(spark.read.parquet(f"{tmp_path}/out").drop("batch_id")) == rows_of(wanted)


@pytest.mark.parametrize("field", ["agent", "referer"])
def test_top_fields(spark, folders, log, tmp_path, field):
    finish_windows(
        spark,
        jobs.top_fields(
            stream(spark, folders["log"], LOG_SCHEMA, 2), field, f"{tmp_path}/state", f"{tmp_path}/out",
            f"{tmp_path}/cp", k=3, interval=None, delay=0,
        ),
    )
    values = logs.field_or_marker(log, field)
    wanted = sliding.top_k_sliding(values, [field], "arrived", k=3)
    assert rows_of(spark.read.parquet(f"{tmp_path}/out").drop("batch_id")) == rows_of(wanted)


def test_popular_terms(spark, folders, events, tmp_path):
    source = posts.stream_posts(spark, folders["posts"], max_files_per_trigger=1)
    finish_windows(
        spark,
        jobs.popular_terms(source, f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/cp", interval=None, delay=0),
    )
    found = words.terms(derived.posts(events))
    wanted = sliding.top_k_sliding(found, ["term"], "ts", 600)
    assert rows_of(spark.read.parquet(f"{tmp_path}/out").drop("batch_id")) == rows_of(wanted)
    assert posts.read_posts(spark, folders["posts"]).count() == events.count()


def test_chained_windows(spark, folders, log, tmp_path):
    urls = logs.url_requests(stream(spark, folders["log"], LOG_SCHEMA))
    finish(runner.to_memory(windows.sliding_stream(urls, ["url"], "arrived", 5, 1, "0 seconds"), "chained", f"{tmp_path}/cp"))
    got = spark.table("chained")
    until = got.agg(F.max("window_end")).first()[0]
    wanted = sliding.sliding_counts(logs.url_requests(log), ["url"], "arrived", 5)
    assert rows_of(got) == rows_of(wanted.where(F.col("window_end") <= until))
    steps = sorted(r["step"] for r in sliding.step_counts(logs.url_requests(log), ["url"], "arrived").collect())
    assert until >= sorted(set(steps))[-2]


def test_alarms_resume(spark, folders, log, tmp_path):
    settings = {"max_ratio": 0.34, "min_total": 20}

    def start(folder):
        return jobs.watch_errors(
            stream(spark, folder, LOG_SCHEMA), f"{tmp_path}/state", f"{tmp_path}/status", f"{tmp_path}/alarms",
            f"{tmp_path}/cp", interval=None, delay=0, **settings,
        )

    in_two_runs(folders["gap"], tmp_path, start, lambda run: finish_windows(spark, run))
    classified = logs.classified_lines(derived.without_gap(log))
    steps = alarms.class_steps(classified, "arrived")
    status = alarms.window_status(steps, **settings).drop("overdue")
    got = spark.read.parquet(f"{tmp_path}/status").drop("batch_id")
    assert rows_of(got) == rows_of(status)
    wanted = alarms.alarms(classified, "arrived", **settings)
    assert {r["kind"] for r in wanted.collect()} == {"error_ratio", "no_data"}
    assert rows_of(spark.read.parquet(f"{tmp_path}/alarms").drop("batch_id")) == rows_of(wanted)


def test_ticks_reveal_silence(spark, tmp_path):
    """Lines stop; only ticks go on.  The no-data alarm comes without another line."""
    base = 1_704_067_200
    line = '1.1.1.1 - - [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 1 "-" "a"'
    made = spark.createDataFrame([(1, base, line), (2, base + 5, line)], "event_id BIGINT, s BIGINT, line STRING")
    made.select("event_id", F.timestamp_seconds("s").alias("arrived"), "line").coalesce(1).write.parquet(
        f"{tmp_path}/lines"
    )
    ticks = spark.range(base, base + 500).select(F.timestamp_seconds("id").alias("ts"))
    ticks.coalesce(1).write.parquet(f"{tmp_path}/ticks")
    finish(
        jobs.watch_errors(
            stream(spark, f"{tmp_path}/lines", LOG_SCHEMA), f"{tmp_path}/state", f"{tmp_path}/status",
            f"{tmp_path}/alarms", f"{tmp_path}/cp", interval=None, delay=0,
            ticks=stream(spark, f"{tmp_path}/ticks", "ts TIMESTAMP"),
        )[0]
    )
    sent = spark.read.parquet(f"{tmp_path}/alarms").where("action = 'issued'").orderBy("window_end").collect()
    first = base + 5 + 300 + 31
    assert [r["window_end"] for r in sent] == list(range(first, base + 500, 31))
    assert spark.read.parquet(f"{tmp_path}/status").agg(F.max("window_end")).first()[0] == base + 499


def session_rows(df):
    return rows_of(df.select("user_id", "session_start", "last_hit", "session_length", "clickstream"))


def test_sessions_resume(spark, folders, events, tmp_path):
    def start(folder):
        return jobs.visitor_sessions(
            stream(spark, folder, EVENT_SCHEMA), f"{tmp_path}/state", f"{tmp_path}/closed", f"{tmp_path}/open",
            f"{tmp_path}/cp", interval=None, key="user_id", kind="BIGINT", ts="ts", seq="event_id",
            item="event_type", gap_seconds=12 * 3600,
        )

    in_two_runs(folders["events"], tmp_path, start)
    closed = spark.read.parquet(f"{tmp_path}/closed").drop("batch_id")
    still_open = spark.read.parquet(f"{tmp_path}/open")
    newest = still_open.agg(F.max("batch_id")).first()[0]
    both = closed.unionByName(still_open.where(F.col("batch_id") == newest).drop("batch_id"))
    wanted = sessions.sessions(events, "user_id", "ts", "event_id", "event_type", 12 * 3600)
    assert newest == PARTS - 1 and session_rows(both) == session_rows(wanted)


@pytest.mark.parametrize("each_hit", [True, False])
def test_session_updates(spark, folders, events, tmp_path, each_hit):
    frame = jobs.visitor_updates(
        stream(spark, folders["events"], EVENT_SCHEMA), key="user_id", kind="BIGINT", seq="event_id",
        item="event_type", gap_seconds=12 * 3600, each_hit=each_hit, delay="0 seconds",
    )
    name = f"updates_{each_hit}"
    finish(runner.to_memory(frame, name, f"{tmp_path}/cp"))
    got = spark.table(name)
    wanted = sessions.sessions(events, "user_id", "ts", "event_id", "event_type", 12 * 3600)
    closed = got.where("closed")
    ends = {(r["user_id"], r["session_length"], tuple(r["clickstream"])) for r in wanted.collect()}
    found = {(r["user_id"], r["session_length"], tuple(r["clickstream"])) for r in closed.collect()}
    assert found <= ends and len(found) > 100
    if each_hit:
        assert got.where("NOT closed").count() == events.count()
    last = got.groupBy("user_id", "session_start").agg(F.max("session_length").alias("n"))
    assert last.agg(F.sum("n")).first()[0] == events.count()
    assert last.count() == wanted.count()


def test_post_lengths(spark, folders, events, tmp_path):
    source = posts.stream_posts(spark, folders["posts"], max_files_per_trigger=1)
    finish(jobs.post_lengths(source, f"{tmp_path}/out", f"{tmp_path}/cp", interval=None))
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("batch_id").collect()
    total = running.total_lengths(derived.posts(events)).first()
    assert len(got) == PARTS
    assert (got[-1]["total_posts"], got[-1]["total_chars"], got[-1]["max_so_far"], got[-1]["average"]) == tuple(total)
    totals = jobs.post_totals(source)
    finish(runner.to_memory(totals, "totals", f"{tmp_path}/cp2", mode="complete"))
    assert tuple(spark.table("totals").first()) == tuple(total)


@pytest.mark.parametrize("limit", [None, 100, 10_000])
def test_save_posts(spark, folders, events, tmp_path, limit):
    source = posts.stream_posts(spark, folders["posts"], max_files_per_trigger=1)
    query, sink = jobs.save_posts(source, f"{tmp_path}/out", f"{tmp_path}/cp", limit, interval=None, files=1)
    finish(query)
    saved = spark.read.text(f"{tmp_path}/out")
    if limit == 100:
        assert sink.reached and saved.select("batch_id").distinct().count() == 1 and saved.count() > 100
    else:
        assert not sink.reached and saved.count() == events.count()
    # a batch that is run again replaces its own folder and does not count twice
    sink(derived.posts(events).limit(5), PARTS + 7)
    sink(derived.posts(events).limit(5), PARTS + 7)
    expected = 0 if limit == 100 else 5
    folder = f"{tmp_path}/out/batch_id={PARTS + 7}"
    assert (spark.read.text(folder).count() if os.path.exists(folder) else 0) == expected
    if limit != 100:
        assert spark.read.text(f"{tmp_path}/out").count() == events.count() + 5


def test_save_until_stops(spark, folders, tmp_path):
    source = posts.stream_posts(spark, folders["posts"], max_files_per_trigger=1)
    jobs.save_until(source, f"{tmp_path}/out", f"{tmp_path}/cp", limit=100, interval="100 milliseconds")
    assert spark.read.text(f"{tmp_path}/out").select("batch_id").distinct().count() == 1


def test_empty_batches(spark, tmp_path):
    none = spark.createDataFrame([], "text STRING")
    sinks.TextBatches(f"{tmp_path}/text")(none, 0)
    sinks.JsonBatches(f"{tmp_path}/json")(none, 0)
    assert not os.path.exists(f"{tmp_path}/text/batch_id=0") and os.path.exists(f"{tmp_path}/json/batch_id=0")


def test_sql_per_batch(spark, folders, log, tmp_path, capfd):
    finish(
        jobs.requests_to_sql(
            stream(spark, folders["log"], LOG_SCHEMA), f"{tmp_path}/out", f"{tmp_path}/json", f"{tmp_path}/cp",
            interval=None, show=True,
        )
    )
    counts = spark.read.parquet(f"{tmp_path}/out")
    assert counts.select("batch_id").distinct().count() == PARTS
    summed = counts.groupBy("agent").agg(F.sum("total").alias("total"))
    assert rows_of(summed) == rows_of(logs.count_by_agent_sql(logs.request_records(log)))
    exported = spark.read.schema("url STRING, status INT, agent STRING").json(f"{tmp_path}/json")
    exported = exported.drop("batch_id")
    assert rows_of(exported) == rows_of(logs.request_records(log).select("url", "status", "agent"))


def test_print_posts(spark, folders, events, tmp_path):
    query = finish(jobs.print_posts(posts.stream_posts(spark, folders["posts"]), f"{tmp_path}/cp", interval=None))
    assert query.lastProgress["numInputRows"] == events.count() and "Console" in query.lastProgress["sink"]["description"]


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", "v INT", keep=2)
    assert table.latest().count() == 0 and table.before(5).count() == 0
    for i in range(5):
        table.write(i, spark.createDataFrame([(i,)], "v INT"))
    table.write(4, spark.createDataFrame([(40,)], "v INT"))
    assert table.versions() == [2, 3, 4]
    assert table.before(3).first()["v"] == 2
    assert (table.before(4).first()["v"], table.latest().first()["v"], table.read(2).first()["v"]) == (3, 40, 2)
    os.remove(f"{tmp_path}/t/v=4/_SUCCESS")  # a version cut short does not count
    assert table.latest().first()["v"] == 3


def write_lines(folder, parts):
    os.makedirs(folder)
    for i, part in enumerate(parts):
        with open(f"{folder}/{i}.txt", "w") as f:
            f.writelines(f"{line}\n" for line in part)
        os.utime(f"{folder}/{i}.txt", (1_700_000_000 + 10 * i,) * 2)


def test_kmeans_stream(spark, tmp_path):
    parts = [[f"[{10 * (i % 5) + j / 10},{j}]" for i in range(20)] for j in range(3)]
    write_lines(f"{tmp_path}/train", parts)
    write_lines(f"{tmp_path}/test", [[f"({i},[{10 * i},1])" for i in range(5)]])
    start = kmeans.KMeansModel(tuple((10.0 * i + 1, 0.0) for i in range(5)), (0.0,) * 5)
    train, test = lines.stream_pair(spark, f"{tmp_path}/train", f"{tmp_path}/test", 1)
    finish(jobs.train_kmeans(train, f"{tmp_path}/model", f"{tmp_path}/cp1", start, interval=None))
    model = start
    for part in parts:
        rows = [([float(x) for x in line[1:-1].split(",")],) for line in part]
        model = kmeans.update(model, spark.createDataFrame(rows, "features ARRAY<DOUBLE>"))
    store = learning.KMeansStore(spark, f"{tmp_path}/model")
    assert store.latest() == model and store.version(0) != model
    # a training batch run again gives the same version
    rows = [([float(x) for x in line[1:-1].split(",")],) for line in parts[2]]
    learning.KMeansTrainer(f"{tmp_path}/model", start)(spark.createDataFrame(rows, "features ARRAY<DOUBLE>"), 2)
    assert store.latest() == model
    finish(jobs.score_kmeans(test, f"{tmp_path}/model", f"{tmp_path}/out", f"{tmp_path}/cp2", start, interval=None))
    scored = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r["label"], r["cluster"]) for r in scored.collect()) == [(i, i) for i in range(5)]


def test_line_stream(spark, tmp_path):
    parts = [[f"{-0.5 * x / 10 + 0.1},{x / 10}" for x in range(-10 + j, 10)] for j in range(3)]
    write_lines(f"{tmp_path}/train", parts)
    write_lines(f"{tmp_path}/test", [["0.1,0.0", "-0.4,1.0", "junk"]])
    train, test = lines.stream_pair(spark, f"{tmp_path}/train", f"{tmp_path}/test", 1)
    finish(jobs.train_line(train, f"{tmp_path}/model", f"{tmp_path}/cp1", interval=None))
    model = regression.LineModel()
    for part in parts:
        rows = [tuple(map(float, line.split(","))) for line in part]
        model = regression.update(model, spark.createDataFrame(rows, "label DOUBLE, feature DOUBLE"))
    assert learning.LineStore(spark, f"{tmp_path}/model").latest() == model
    finish(jobs.score_line(test, f"{tmp_path}/model", f"{tmp_path}/out", f"{tmp_path}/cp2", version=2, interval=None))
    scored = {r["label"]: r["prediction"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert scored == {0.1: model.intercept, -0.4: model.slope + model.intercept}


def test_visitors_from_raw_lines(spark, folders, log, tmp_path, capfd):
    hits = logs.visitor_hits(lines.arriving(lines.stream_lines(spark, folders["text"], 2)))
    finish(
        jobs.visitor_sessions(
            hits, f"{tmp_path}/state", f"{tmp_path}/closed", f"{tmp_path}/open", f"{tmp_path}/cp", interval=None,
            show=True, ts="arrived",
        )
    )
    newest = spark.read.parquet(f"{tmp_path}/open").where("batch_id = 1")
    wanted = logs.visitor_hits(log).groupBy("ip").agg(F.count("*").alias("session_length"))
    assert rows_of(newest.select("ip", "session_length")) == rows_of(wanted)
    assert newest.agg(F.max(F.size("clickstream"))).first()[0] == 10
    assert "clickstream" in capfd.readouterr().out


def test_complete_console(spark, folders, log, tmp_path):
    frame = jobs.status_windows(lines.stream_lines(spark, folders["text"]))
    query = finish(runner.to_console(frame, f"{tmp_path}/cp", interval=None, mode="complete", rows=20))
    assert query.lastProgress["numInputRows"] == log.count() and "Console" in query.lastProgress["sink"]["description"]


def counted(spark, window, parts, tmp_path, delay=0, restart_after=2):
    """Window counts of a job that gets ``parts``, each a list of (key, second), as batches, with a restart among them."""
    out = sinks.ParquetBatches(f"{tmp_path}/out")
    sink = counts.TopWindows(f"{tmp_path}/cp", out, "k", k=100, window=window, delay=delay, late=counts.late_to(f"{tmp_path}/late"))
    os.makedirs(f"{tmp_path}/in")
    for some in (parts[:restart_after], parts[restart_after:]):
        for part in some:
            number = len(os.listdir(f"{tmp_path}/in"))
            rows = spark.createDataFrame(part, "k STRING, s BIGINT").select("k", F.timestamp_seconds("s").alias("at"))
            rows.toPandas().to_parquet(f"{tmp_path}/in/{number}.parquet", coerce_timestamps="us")
            os.utime(f"{tmp_path}/in/{number}.parquet", (1_700_000_000 + 10 * number,) * 2)
        frame = sink.stretches(stream(spark, f"{tmp_path}/in", "k STRING, at TIMESTAMP"), "at")
        query = runner.for_each_batch(frame, sink, f"{tmp_path}/cp", None)  # a row that only tells an old time may be dropped
        query.awaitTermination()
        assert query.exception() is None
        sink.close(spark)
    sink.close(spark)  # closing again changes nothing
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    got = sorted((r["window_end"], r["k"], r["n"]) for r in rows)
    assert len(set(r[:2] for r in got)) == len(got)
    return got


def all_windows(rows, window):
    ends = {(s + i, k) for k, s in rows for i in range(1, window + 1)}
    return sorted((t, k, sum(k == k2 and t - window <= s < t for k2, s in rows)) for t, k in ends)


@pytest.mark.parametrize("window", [40])
def test_windows_in_many_batches(spark, tmp_path, window):
    """Uneven batches with pauses longer than a window: no window is lost or wrong."""
    rng = random.Random(window)
    seconds = sorted(rng.randint(1000, 1300) for _ in range(150)) + [1301, 1400, 1401, 1600]
    rows = [(rng.choice("aaab"), s) for s in seconds]
    cuts = [0, 3, 40, 41, 90, 140, 152, 153, len(rows)]
    assert counted(spark, window, [rows[a:b] for a, b in zip(cuts, cuts[1:])], tmp_path) == all_windows(rows, window)


def test_late_rows_count_where_windows_are_open(spark, tmp_path):
    parts = [[("a", 100), ("a", 110)], [("a", 104), ("b", 60), ("a", 130)]]
    got = counted(spark, 20, parts, tmp_path)
    assert dict(((t, k), n) for t, k, n in got if t > 110) == {
        (t, "a"): sum(t - 20 <= s < t for s in (100, 104, 110, 130)) for t in range(111, 151) if any(t - 20 <= s < t for s in (100, 104, 110, 130))
    }
    late = {(r["k"], r["step"], r["lost"]) for r in spark.read.parquet(f"{tmp_path}/late").collect()}
    assert late == {("a", 104, False), ("b", 60, True)}
    assert counted(spark, 20, parts, f"{tmp_path}/patient", delay=100) == all_windows([r for p in parts for r in p], 20)


def test_windows_leave_nothing_behind(spark, folders, tmp_path):
    """No batch writes below the shared folder; the state lies with the checkpoint."""
    shared = spark.conf.get("spark.checkpoint.dir")
    before = sorted(os.listdir(shared))
    run = jobs.top_urls(stream(spark, folders["log"], LOG_SCHEMA), f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/cp", interval=None)
    finish_windows(spark, run)
    assert sorted(os.listdir(shared)) == before and not os.path.exists(f"{tmp_path}/state")


def test_alarms_leave_no_folders_of_their_batches(spark, folders, log, tmp_path):
    """What a batch uses several times is gone when it has ended; the state holds a few small tables."""
    shared = spark.conf.get("spark.checkpoint.dir")
    before = sorted(os.listdir(shared))
    run = jobs.watch_errors(
        stream(spark, folders["log"], LOG_SCHEMA), f"{tmp_path}/state", f"{tmp_path}/status", f"{tmp_path}/alarms", f"{tmp_path}/cp", interval=None
    )
    finish_windows(spark, run)
    assert sorted(os.listdir(shared)) == before and os.listdir(f"{tmp_path}/status")


def test_passing_scratch_is_deleted_after_a_failure(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = sorted(os.listdir(shared))
    with pytest.raises(KeyError), passing_scratch(spark, "some") as staged:
        assert staged(spark.range(5), "rows").count() == 5 and sorted(os.listdir(shared)) != before
        raise KeyError
    assert sorted(os.listdir(shared)) == before


def test_live_top_k_drops_weak_keys_before_expanding(spark):
    """Stretches that cannot rank are gone before a stretch becomes a row per second."""
    stretches = [("big", 6000, 6600, 50)] + [(f"rare{i}", 6000 + i, 6300 + i, 1) for i in range(100)]
    df = spark.createDataFrame(stretches, "key STRING, from_t BIGINT, until_t BIGINT, n BIGINT")
    able = sliding.able_intervals(df, ["key"], 1)
    assert {r["key"] for r in able.collect()} == {"big"} and able.count() == 10
    ranked = counts.TopWindows("", None, "key", k=1).ranked(df).collect()
    assert len(ranked) == 600 and {(r["key"], r["rank"], r["n"]) for r in ranked} == {("big", 1, 50)}


def test_unusable_lines_are_counted(spark, tmp_path):
    """Vectors of another length and a model that has run away neither stop training nor get an answer."""
    start = kmeans.KMeansModel(((0.0, 0.0), (10.0, 0.0)), (0.0, 0.0))
    batch = spark.createDataFrame([([1.0, 0.0],), ([1.0],), (None,), ([9.0, 1.0, 2.0],)], "features ARRAY<DOUBLE>")
    learning.KMeansTrainer(f"{tmp_path}/m", start)(batch, 0)
    assert learning.unused_rows(spark, f"{tmp_path}/m").latest().first()["rows"] == 3
    assert learning.KMeansStore(spark, f"{tmp_path}/m").latest().centres[0] == pytest.approx((1.0, 0.0))
    assert [r["cluster"] for r in kmeans.assign(batch, start).collect()] == [0, None, None, None]
    points = spark.createDataFrame([(1.0, 19_000.0), (2.0, 18_000.0)], "label DOUBLE, feature DOUBLE")
    trainer = learning.LineTrainer(f"{tmp_path}/l")
    for i in range(3):
        trainer(points, i)
    assert learning.LineStore(spark, f"{tmp_path}/l").table.versions() == [0, 1, 2]


def test_late_hit_inside_a_carried_session(spark, tmp_path):
    hits = [(i, "v", s, f"/p{s}") for i, s in enumerate([90, *range(150, 270, 10)])]
    late = [(100, "v", 155, "/p155"), (101, "v", 270, "/p270")]
    made = lambda rows: spark.createDataFrame(rows, "event_id BIGINT, ip STRING, s BIGINT, url STRING").select(
        "event_id", "ip", F.timestamp_seconds("s").alias("arrived"), "url"
    )
    kept = {}
    sink = SessionBatches(
        f"{tmp_path}/state", lambda df, i: None, lambda df, i: kept.update({i: [r["clickstream"] for r in df.collect()]}),
        ts="arrived", gap_seconds=100,
    )
    sink(made(hits), 0)
    sink(made(late), 1)
    wanted = sessions.sessions(made(hits + late), "ip", "arrived", "event_id", "url", 100).collect()
    assert kept[1] == [r["clickstream"] for r in wanted]
