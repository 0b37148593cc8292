import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import running
from millrace.plans import jobs

BASE = 1_704_067_200


def posts(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, s BIGINT, text STRING").select(
        "id", F.timestamp_seconds("s").alias("ts"), "text"
    )


def test_running_lengths(spark):
    rows = [(1, BASE, "abc"), (2, BASE, "a😀"), (3, BASE + 2, "x" * 10), (4, BASE + 86_400, "y")]
    batches = running.batch_lengths(posts(spark, rows))
    got = [tuple(r) for r in running.running_lengths(batches).orderBy("batch").collect()]
    assert got == [
        (BASE, 2, 6, 3, 3, 3),
        (BASE + 2, 3, 16, 5, 10, 10),
        (BASE + 86_400, 4, 17, 4, 1, 10),
    ]


def test_total_lengths(spark):
    assert tuple(running.total_lengths(posts(spark, [(1, BASE, "abc"), (2, BASE, "abcd")])).first()) == (2, 7, 4, 3)
    assert running.total_lengths(posts(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [0, 9, 10, 11, 1000])
def test_stop_after(spark, limit):
    rng = random.Random(limit)
    seconds = sorted(rng.randrange(30) for _ in range(60))
    rows = [(i, BASE + s, "t") for i, s in enumerate(seconds)]
    kept, total = [], 0
    for second in sorted(set(seconds)):
        if total > limit:
            break
        batch = [i for i, s, _ in rows if s == BASE + second]
        kept, total = kept + batch, total + len(batch)
    got = running.stop_after(posts(spark, rows), limit, chunk=5).collect()
    assert sorted(r["id"] for r in got) == kept


def test_print_batches(spark):
    rows = [(i, BASE + i // 12, f"t{i}") for i in range(24)]
    got = jobs.print_batches(posts(spark, rows)).collect()
    assert sorted(r["id"] for r in got) == [*range(10), *range(12, 22)]
