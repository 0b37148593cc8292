import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import alarms as al

BASE = 1_704_067_200


def greedy(times, pause):
    sent, last = [], None
    for t in sorted(times):
        if last is None or t - last > pause:
            sent.append(t)
            last = t
    return sent


def due(spark, times):
    return spark.createDataFrame([(t, "x") for t in times], "window_end BIGINT, kind STRING")


@pytest.mark.parametrize("pause, chunk", [(30, 86_400), (30, 31), (30, 60), (5, 10)])
@pytest.mark.parametrize("density", [0.02, 0.3, 1.0])
def test_issue_times(spark, pause, chunk, density):
    rng = random.Random(17)
    times = [BASE + i for i in range(400) if rng.random() < density]
    got = sorted(r[0] for r in al.issued_times(due(spark, times), pause, chunk).collect())
    assert got == greedy(times, pause)


def test_pause_limit_and_start(spark):
    log = al.alarm_log(due(spark, [BASE, BASE + 30, BASE + 31, BASE + 70]))
    assert [(r["window_end"] - BASE, r["action"]) for r in log.orderBy("window_end").collect()] == [
        (0, "issued"), (30, "suppressed"), (31, "issued"), (70, "issued"),
    ]
    later = al.issued_times(due(spark, [BASE, BASE + 40, BASE + 50]), free_from=BASE + 45).collect()
    assert [r[0] - BASE for r in later] == [50]
    assert al.alarm_log(due(spark, [])).count() == 0


@pytest.mark.parametrize(
    "success, failure, ratio, state",
    [
        (60, 40, None, "too_few"),
        (61, 40, 40 / 61, "alarm"),
        (100, 50, 0.5, "ok"),
        (100, 51, 0.51, "alarm"),
        (0, 101, float("inf"), "alarm"),
        (101, 0, 0.0, "ok"),
        (0, 0, None, "too_few"),
    ],
)
def test_rule(spark, success, failure, ratio, state):
    frame = spark.createDataFrame([(success, failure)], "s BIGINT, f BIGINT")
    r = al.error_ratio(F.col("s"), F.col("f"))
    assert tuple(frame.select(r, al.window_state(r, F.lit(1))).first()) == (ratio, state)


def classified(spark, rows):
    return spark.createDataFrame(rows, "s BIGINT, status_class STRING").select(
        F.timestamp_seconds("s").alias("ts"), "status_class"
    )


def test_status_covers_every_slide(spark):
    rows = [(BASE, "Success"), (BASE + 3, "Failure"), (BASE + 40, "Other")]
    steps = al.class_steps(classified(spark, rows), "ts")
    got = {r["window_end"] - BASE: r for r in al.window_status(steps, window=10, max_silence=5).collect()}
    assert sorted(got) == list(range(1, 51))
    for end, row in got.items():
        seen = [c for s, c in rows if end - 10 <= s - BASE < end]
        assert (row["n"], row["success"], row["failure"]) == (len(seen), seen.count("Success"), seen.count("Failure"))
        assert (row["state"] == "empty") == (not seen)
    # last seen in the window that ends at 13
    assert [e for e in sorted(got) if got[e]["overdue"]] == list(range(19, 41))


@pytest.mark.parametrize("seconds, alarms", [(330, 0), (331, 1), (361, 1), (362, 2)])
def test_no_data(spark, seconds, alarms):
    rows = [(BASE, "Success"), (BASE + seconds, "Success")]
    log = al.alarms(classified(spark, rows), "ts").where("action = 'issued'").collect()
    assert [r["kind"] for r in log] == ["no_data"] * alarms
    assert [r["window_end"] - BASE for r in log] == [331, 362][:alarms]


def test_silence_over_days_needs_no_long_arrays(spark):
    rows = [(BASE, "Success"), (BASE + 3 * 86_400, "Success")]
    steps = al.class_steps(classified(spark, rows), "ts")
    stretches = al.silent_stretches(steps).collect()
    assert len(stretches) == 4 and max(r["until_t"] - r["from_t"] for r in stretches) <= 86_400
    assert sum(r["until_t"] - r["from_t"] for r in stretches) == 3 * 86_400 - 300


def test_shared_pause(spark):
    """A no-data alarm and a ratio alarm use the same clock."""
    rows = [(BASE, "Failure")] * 200 + [(BASE + 332, "Failure")] * 200
    log = al.alarms(classified(spark, rows), "ts").orderBy("window_end").collect()
    sent = [(r["window_end"] - BASE, r["kind"]) for r in log if r["action"] == "issued"]
    everything = [r["window_end"] for r in log]
    assert [BASE + t for t, _ in sent] == greedy(everything, 30)
    assert (331, "no_data") not in sent or (333, "error_ratio") not in sent
