import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import sessions as ops

BASE = 1_704_067_200


def brute(rows, gap, keep):
    found = []
    by_key = {}
    for key, second, seq, item in rows:
        by_key.setdefault(key, []).append((second, seq, item))
    for key, hits in by_key.items():
        current = []
        for hit in sorted(hits):
            if current and hit[0] - current[-1][0] > gap:
                found.append((key, current))
                current = []
            current.append(hit)
        found.append((key, current))
    return sorted(
        (str(k), h[0][0], h[-1][0], len(h), [i for _, _, i in h[:keep]]) for k, h in found
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, "ip STRING, s BIGINT, seq BIGINT, url STRING").select(
        "ip", F.timestamp_seconds("s").alias("ts"), "seq", "url"
    )


def flat(found):
    return sorted(
        (str(r["ip"]), int(r["session_start"].timestamp()), int(r["last_hit"].timestamp()), r["session_length"], r["clickstream"])
        for r in found.collect()
    )


@pytest.mark.parametrize("gap, span", [(100, 2000), (37, 3000), (1800, 9000)])
def test_against_brute_force(spark, gap, span):
    rng = random.Random(gap)
    rows = [
        (rng.choice(["hot", "hot", "a", "b", None]), BASE + rng.randrange(span), i, f"/{rng.randrange(5)}") for i in range(250)
    ]
    assert flat(ops.sessions(frame(spark, rows), "ip", "ts", "seq", "url", gap)) == brute(rows, gap, 10)


@pytest.mark.parametrize("second, wanted", [(29 * 60 + 59, 1), (30 * 60, 1), (30 * 60 + 1, 2)])
def test_gap_limit(spark, second, wanted):
    rows = [("a", BASE, 1, "/1"), ("a", BASE + second, 2, "/2")]
    assert ops.sessions(frame(spark, rows), "ip", "ts", "seq", "url").count() == wanted


@pytest.mark.parametrize("n", [10, 11])
def test_first_ten(spark, n):
    rows = [("a", BASE + i // 3, i, f"/{i}") for i in range(n)]
    row = ops.sessions(frame(spark, rows), "ip", "ts", "seq", "url").first()
    assert row["session_length"] == n and row["clickstream"] == [f"/{i}" for i in range(10)]


def test_snapshot(spark):
    rows = [("a", BASE, 1, "/1"), ("a", BASE + 5000, 2, "/2"), ("b", BASE + 100, 3, "/3")]
    found = ops.sessions(frame(spark, rows), "ip", "ts", "seq", "url")
    assert [(r["ip"], r["clickstream"]) for r in ops.session_snapshot(found, "ip").orderBy("ip").collect()] == [
        ("a", ["/2"]), ("b", ["/3"]),
    ]
    live = ops.session_snapshot(found, "ip", at="2024-01-01 01:30:00")
    assert [r["ip"] for r in live.collect()] == ["a"]


def test_hits_are_reduced_before_the_shuffle(spark):
    plan = ops.sessions(frame(spark, [("a", BASE, 1, "/1")]), "ip", "ts", "seq", "url")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and "row_number(), 10, Partial" in text
