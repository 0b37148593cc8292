"""Every query by name: ``(spark, table folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import access_log as al
from millrace.functions.vectors import parse_labeled, parse_vector
from millrace.operators import alarms, kmeans, logs, regression, running, sessions, sliding, words
from millrace.plans import jobs
from millrace.session import scratch_path, prepare
from millrace.sources import derived
from millrace.sources.lines import read_lines

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
LOW_RATIO = 1.0 / 3.0
DAY_GAP = 12 * 3600
CLUSTERS = 5


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _QUERIES[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    from millrace.plans import resumed_queries, stream_queries  # noqa: F401  (they register themselves)

    return dict(_QUERIES)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.table(spark, sf_dir, "events")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.access_log(events(spark, sf_dir))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.posts(events(spark, sf_dir))


def seconds(column: str, name: str) -> "F.Column":
    return F.unix_seconds(column).alias(name)


# -- log lines -------------------------------------------------------------------------------------


@query
def parse_access_log(spark, sf_dir):
    """All fields of every line."""
    parsed = logs.parse_access_log(log(spark, sf_dir))
    names = [n for n in al.FIELDS if n != "date_time"]
    return parsed.select(
        "event_id",
        "matched",
        F.coalesce(F.unix_seconds("ts"), F.lit(-1)).alias("ts_seconds"),
        *[F.coalesce(n, F.lit("")).alias(n) for n in names],
    )


@query
def log_time(spark, sf_dir):
    parsed = logs.parse_access_log(log(spark, sf_dir), "drop", fields=["ts"])
    return parsed.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("log_time"))


@query
def unmatched_policies(spark, sf_dir):
    """What each job makes of every line, corrupt ones included."""
    lines = log(spark, sf_dir)
    parsed = logs.parse_access_log(lines, fields=["request", "status", "agent"])
    ok, request = F.col("matched"), F.col("request")
    return parsed.select(
        "event_id",
        F.when(ok, al.url_strict(request)).otherwise(F.lit(al.BAD_URL)).alias("bucket_url"),
        F.when(ok, F.col("agent")).otherwise(F.lit(logs.NO_FIELD)).alias("bucket_agent"),
        F.when(ok, al.url_lenient(request)).otherwise(F.lit("error")).alias("sentinel_url"),
        al.status_class(F.col("status")).alias("status_class"),
        ok.alias("kept_by_drop"),
    )


@query
def url_lenient_vs_strict(spark, sf_dir):
    parsed = logs.parse_access_log(log(spark, sf_dir), "drop", fields=["request"])
    request = F.col("request")
    return parsed.select("event_id", al.url_strict(request).alias("strict"), al.url_lenient(request).alias("lenient"))


@query
def request_records(spark, sf_dir):
    return logs.request_records(log(spark, sf_dir)).select("event_id", "url", "status", "agent")


@query
def agent_counts_sql(spark, sf_dir):
    return logs.count_by_agent_sql(logs.request_records(log(spark, sf_dir)))


@query
def agent_counts_per_batch(spark, sf_dir):
    return jobs.agents_per_batch(log(spark, sf_dir))


@query
def json_export_roundtrip(spark, sf_dir):
    """Records written as JSON, one folder per minute of arrival, and read back."""
    out = scratch_path(spark, "records-json")
    records = logs.request_records(log(spark, sf_dir))
    minute = F.expr("unix_seconds(arrived) div 60").alias("batch_id")
    chosen = records.select("event_id", "url", "status", "agent", minute)
    # few files per folder, and a busy minute spreads over several tasks
    chosen.hint("rebalance", "batch_id").write.partitionBy("batch_id").json(out)
    return spark.read.schema("event_id BIGINT, url STRING, status INT, agent STRING, batch_id BIGINT").json(out)


@query
def text_export_roundtrip(spark, sf_dir):
    """Post texts written as plain text, one folder per minute of arrival, and counted when read back."""
    out = scratch_path(spark, "posts-text")
    minute = F.expr("unix_seconds(ts) div 60").alias("batch_id")
    chosen = posts(spark, sf_dir).select("text", minute)
    chosen.hint("rebalance", "batch_id").write.partitionBy("batch_id").text(out)
    return read_lines(spark, out).groupBy(F.col("batch_id").cast("bigint").alias("batch_id"), "line").agg(
        F.count("*").alias("n")
    )


@query
def status_class_counts(spark, sf_dir):
    classified = logs.classified_lines(log(spark, sf_dir))
    return classified.groupBy("status_class").agg(F.count("*").alias("n"))


# -- windows ---------------------------------------------------------------------------------------


def flat_windows(windows: DataFrame) -> DataFrame:
    return windows.select("status", seconds("window.start", "window_start"), seconds("window.end", "window_end"), "n")


@query
def status_by_window(spark, sf_dir):
    return flat_windows(jobs.status_windows(log(spark, sf_dir), "10 minutes"))


@query
def status_by_hour(spark, sf_dir):
    return flat_windows(jobs.status_windows(log(spark, sf_dir)))


@query
def sliding_url_counts(spark, sf_dir):
    return sliding.sliding_counts(logs.url_requests(log(spark, sf_dir)), ["url"], "arrived")


@query
def sliding_status_counts(spark, sf_dir):
    return sliding.sliding_counts(logs.classified_lines(log(spark, sf_dir)), ["status_class"], "arrived")


@query
def sliding_delta_points(spark, sf_dir):
    """The sliding URL counts as stretches of equal count, cut at full hours."""
    steps = sliding.step_counts(logs.url_requests(log(spark, sf_dir)), ["url"], "arrived")
    return sliding.sliding_intervals(steps, ["url"]).select("url", "from_t", "until_t", "n")


@query
def leading_urls(spark, sf_dir):
    """The first two of the handful of URLs, so that the limit acts and ties are met."""
    return jobs.top_urls(log(spark, sf_dir), k=2)


@query
def leading_agents(spark, sf_dir):
    return jobs.top_agents(log(spark, sf_dir), k=3)


@query
def leading_referrer(spark, sf_dir):
    return jobs.top_referrers(log(spark, sf_dir), k=1)


@query
def top_urls(spark, sf_dir):
    return jobs.top_urls(log(spark, sf_dir))


@query
def top_agents(spark, sf_dir):
    return jobs.top_agents(log(spark, sf_dir))


@query
def top_referrers(spark, sf_dir):
    return jobs.top_referrers(log(spark, sf_dir))


@query
def trending_terms(spark, sf_dir):
    return jobs.popular_terms(posts(spark, sf_dir))


# -- words and posts -------------------------------------------------------------------------------


@query
def word_count(spark, sf_dir):
    return words.word_count(derived.table(spark, sf_dir, "documents"))


@query
def top_words(spark, sf_dir):
    return words.top_words(derived.table(spark, sf_dir, "documents"))


@query
def first_posts(spark, sf_dir):
    """The first two posts of every batch: most batches have more."""
    return jobs.print_batches(posts(spark, sf_dir), 2)


@query
def print_batches(spark, sf_dir):
    return jobs.print_batches(posts(spark, sf_dir))


@query
def text_lengths(spark, sf_dir):
    """Length of every document in UTF-16 units and in code points."""
    documents = derived.table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        running.text_length(F.col("text")).alias("units"),
        running.text_length(F.col("text"), "codepoint").alias("points"),
    )


@query
def running_length(spark, sf_dir):
    found = jobs.running_post_lengths(posts(spark, sf_dir))
    return found.select("batch", "total_posts", "total_chars", "average")


@query
def running_max_length(spark, sf_dir):
    return jobs.running_post_lengths(posts(spark, sf_dir))


@query
def total_lengths(spark, sf_dir):
    return running.total_lengths(posts(spark, sf_dir))


@query
def stop_after_n(spark, sf_dir):
    return running.stop_after(posts(spark, sf_dir)).select("id", "text")


# -- sessions --------------------------------------------------------------------------------------


def flat_sessions(found: DataFrame, key: str, *more: str) -> DataFrame:
    return found.select(
        key,
        *more,
        F.unix_micros("session_start").alias("start_us"),
        F.unix_micros("last_hit").alias("last_us"),
        "session_length",
        F.array_join("clickstream", " ").alias("clicks"),
    )


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessions(events(spark, sf_dir), "user_id", "ts", "event_id", "event_type", DAY_GAP)


def visitor_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.visitor_sessions(log(spark, sf_dir))


@query
def sessions_by_user(spark, sf_dir):
    return flat_sessions(user_sessions(spark, sf_dir), "user_id")


@query
def sessions_by_ip(spark, sf_dir):
    found = flat_sessions(visitor_sessions(spark, sf_dir), "ip")
    return found.withColumn("ip", F.coalesce("ip", F.lit("")))


@query
def session_snapshot(spark, sf_dir):
    return flat_sessions(sessions.session_snapshot(user_sessions(spark, sf_dir), "user_id", DAY_GAP), "user_id")


@query
def live_sessions(spark, sf_dir):
    """Sessions still open at one moment of history."""
    at = "2024-01-31 00:00:00"
    live = sessions.session_snapshot(user_sessions(spark, sf_dir), "user_id", DAY_GAP, at)
    return flat_sessions(live, "user_id")


# -- alarms ----------------------------------------------------------------------------------------


def gap_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.without_gap(log(spark, sf_dir))


@query
def error_ratio(spark, sf_dir):
    """Totals, ratio and state of every window, silent ones included."""
    steps = alarms.class_steps(logs.classified_lines(log(spark, sf_dir)), "arrived")
    status = alarms.window_status(steps).drop("overdue")
    return status.withColumn("ratio", F.coalesce(F.round("ratio", 9), F.lit(-1.0)))


@query
def no_data_alarms(spark, sf_dir):
    steps = alarms.class_steps(logs.classified_lines(gap_log(spark, sf_dir)), "arrived")
    return alarms.no_data_candidates(alarms.window_status(steps))


@query
def alarms_issued(spark, sf_dir):
    """Alarms that go out, with a ratio bound low enough that there are some."""
    found = jobs.alarm_history(log(spark, sf_dir), max_ratio=LOW_RATIO)
    return found.where("action = 'issued'").select("window_end", "kind")


@query
def alarms_issued_with_silence(spark, sf_dir):
    """The same with the usual settings, for a log with ten silent minutes cut out."""
    found = jobs.alarm_history(gap_log(spark, sf_dir))
    return found.where("action = 'issued'").select("window_end", "kind")


@query
def alarm_log(spark, sf_dir):
    """Fate of every due alarm, with a ratio bound low enough that both kinds occur."""
    return jobs.alarm_history(log(spark, sf_dir), max_ratio=LOW_RATIO)


@query
def alarm_log_with_silence(spark, sf_dir):
    """The same for a log with ten silent minutes cut out, so that both kinds share the pause."""
    return jobs.alarm_history(gap_log(spark, sf_dir), max_ratio=LOW_RATIO)


# -- learning --------------------------------------------------------------------------------------


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.vectors(derived.table(spark, sf_dir, "embeddings"))


def first_centres(spark: SparkSession, sf_dir: str) -> kmeans.KMeansModel:
    """Starting centres: the lowest-numbered vector of each label group."""
    groups = points(spark, sf_dir).groupBy((F.col("label") % CLUSTERS).alias("g"))
    rows = groups.agg(F.min_by("features", "vec_id").alias("c")).orderBy("g").collect()
    return kmeans.KMeansModel(tuple(tuple(r["c"]) for r in rows), (0.0,) * len(rows))


@query
def kmeans_assign(spark, sf_dir):
    found = kmeans.assign(points(spark, sf_dir), first_centres(spark, sf_dir))
    return found.select("vec_id", "label", "cluster")


@query
def parsed_vectors(spark, sf_dir):
    """Vectors written as ``[a,b,..]`` and read back."""
    text = points(spark, sf_dir).select("vec_id", F.to_json("features").alias("line"))
    parsed = text.select("vec_id", parse_vector(F.col("line")).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return parsed.select("vec_id", F.size("v").alias("n"), F.round(total, 4).alias("total"))


@query
def parsed_points(spark, sf_dir):
    """Points written as ``label,feature`` and read back."""
    xy = derived.labelled_points(events(spark, sf_dir))
    text = xy.select("id", F.concat_ws(",", F.col("label").cast("string"), F.col("feature").cast("string")).alias("line"))
    parsed = text.select("id", parse_labeled(F.col("line")).alias("p"))
    feature = F.get("p.features", F.lit(0))
    return parsed.select("id", F.round("p.label", 6).alias("label"), F.round(feature, 6).alias("feature"))


@query
def kmeans_agreement(spark, sf_dir):
    return kmeans.label_agreement(kmeans.assign(points(spark, sf_dir), first_centres(spark, sf_dir)))


@query
def kmeans_step(spark, sf_dir):
    """Centres after one batch that starts from weightless centres: the mean of each cluster."""
    sums = kmeans.batch_sums(points(spark, sf_dir), first_centres(spark, sf_dir))
    spread = sums.select("cluster", "n", F.posexplode("total").alias("axis", "total"))
    return spread.select("cluster", "n", "axis", F.round(F.col("total") / F.col("n"), 6).alias("centre"))


def xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.labelled_points(events(spark, sf_dir))


@query
def regression_exact(spark, sf_dir):
    line = regression.exact_line(xy(spark, sf_dir))
    return line.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")])


@query
def regression_predict(spark, sf_dir):
    data = xy(spark, sf_dir)
    predicted = regression.predict_by(data, regression.exact_line(data))
    return regression.errors(predicted).select(
        "n", F.round("mean_abs", 6).alias("mean_abs"), F.round("rmse", 6).alias("rmse")
    )


@query
def regression_sgd(spark, sf_dir):
    line = regression.sgd_line(regression.moments(xy(spark, sf_dir)))
    return line.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query
def standardised_moments(spark, sf_dir):
    scaled = regression.standardise(xy(spark, sf_dir), "label", "feature")
    sums = regression.moments(scaled)
    return sums.select(*[(F.round(F.col(c), 5) + 0.0).alias(c) for c in ("n", "sxx", "sxy")])
