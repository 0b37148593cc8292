import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import sliding
from millrace.operators.timeline import prefix_scan

BASE = 1_704_067_200


def brute(rows, window, slide):
    counts = Counter()
    for key, second in rows:
        step = second - second % slide
        for end in range(step + slide, step + window + 1, slide):
            counts[(end, key)] += 1
    return counts


def frame(spark, rows):
    return spark.createDataFrame(rows, "k STRING, s BIGINT").select("k", F.timestamp_seconds("s").alias("ts"))


def sample(seed, n=120, span=900):
    rng = random.Random(seed)
    # one key holds more than a third of the rows
    return [(rng.choice(["hot", "hot", "a", "b", "c"]), BASE + rng.randrange(span)) for _ in range(n)]


@pytest.mark.parametrize("window, slide, chunk", [(300, 1, 3600), (300, 1, 301), (60, 5, 100), (10, 10, 10), (30, 1, 31)])
def test_against_brute_force(spark, window, slide, chunk):
    for seed in range(2):
        rows = sample(seed)
        got = sliding.sliding_counts(frame(spark, rows), ["k"], "ts", window, slide, chunk).collect()
        assert {(r["window_end"], r["k"]): r["n"] for r in got} == dict(brute(rows, window, slide))
        assert len(got) == len(brute(rows, window, slide))


def test_window_must_be_whole_slides(spark):
    with pytest.raises(ValueError):
        sliding.sliding_counts(frame(spark, []), ["k"], "ts", 10, 3)


def test_against_built_in_window(spark):
    rows = frame(spark, sample(9, 60, 100))
    ours = sliding.sliding_counts(rows, ["k"], "ts", 20, 1, 21)
    theirs = sliding.expanded_counts(rows, ["k"], "ts", 20, 1)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


@pytest.mark.parametrize("k, block", [(1, 60), (2, 60), (3, 7), (10, 60)])
def test_top_k(spark, k, block):
    rows = sample(5, 300)
    window, slide = 120, 1
    per_end = {}
    for (end, key), n in brute(rows, window, slide).items():
        per_end.setdefault(end, []).append((-n, key))
    wanted = {
        (end, i + 1, key, -n) for end, found in per_end.items() for i, (n, key) in enumerate(sorted(found)[:k])
    }
    got = sliding.top_k_sliding(frame(spark, rows), ["k"], "ts", window, slide, k, block, chunk=200).collect()
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted)


def test_top_k_drops_weak_keys_before_expanding(spark):
    """Rare keys below the k-th floor are cut away while rows still stand for stretches."""
    rows = [("big", BASE + i) for i in range(600)] + [(f"rare{i}", BASE + 300 + i) for i in range(50)]
    got = sliding.top_k_sliding(frame(spark, rows), ["k"], "ts", 300, 1, 1).where("k <> 'big'")
    assert got.count() == 0


def test_rank_limit_runs_before_the_shuffle(spark):
    plan = sliding.top_k_sliding(frame(spark, sample(1)), ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 10, Partial" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_prefix_scan(spark, chunk):
    rng = random.Random(3)
    keys = sorted(rng.sample(range(-50, 200), 40))
    values = [(k, rng.randrange(100)) for k in keys]
    got = prefix_scan(spark.createDataFrame(values, "o BIGINT, v BIGINT"), "o", ["v"], ["v"], chunk).orderBy("o").collect()
    total, top, previous = 0, 0, None
    for row, (order, value) in zip(got, values, strict=True):
        total, top = total + value, max(top, value)
        assert tuple(row) == (order, value, total, top, previous)
        previous = order
