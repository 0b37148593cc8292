import pytest
from pyspark.sql import functions as F

from millrace.functions import access_log as al
from millrace.operators import logs

GOOD = '10.0.0.1 - bob [29/Nov/2015:03:50:05 +0300] "GET /a HTTP/1.1" 200 12 "http://r/" "agent x"'


def parsed(spark, line, unmatched="keep"):
    return logs.parse_access_log(spark.createDataFrame([(line,)], "line STRING"), unmatched).collect()


def test_all_fields(spark):
    row = parsed(spark, GOOD)[0]
    assert row["matched"]
    assert [row[c] for c in ("ip", "client", "user", "request", "status", "bytes", "referer", "agent")] == [
        "10.0.0.1", "-", "bob", "GET /a HTTP/1.1", "200", "12", "http://r/", "agent x",
    ]
    assert str(row["ts"]) == "2015-11-29 03:50:05"  # the zone is not applied


@pytest.mark.parametrize(
    "change, matched",
    [
        (lambda s: s[len("10.0.0.1"):], True),  # no address
        (lambda s: s.replace("10.0.0.1", "::1"), False),
        (lambda s: s.replace(" 200 ", " 20 "), False),
        (lambda s: s.replace("agent x", ""), True),
        (lambda s: s + " more", False),
        (lambda s: s.replace("/a", '/a"b'), True),
        (lambda s: s + "\n", False),
        (lambda s: "\n" * 8, False),  # as many pieces as fields, yet no match
        (lambda s: s.replace("/a", "/a\x01b"), True),
        (lambda s: None, False),
    ],
)
def test_match(spark, change, matched):
    row = parsed(spark, change(GOOD))[0]
    assert row["matched"] is matched
    assert (row["agent"] is not None) is matched
    assert len(parsed(spark, change(GOOD), "drop")) == matched


def test_no_address_is_null_and_inner_quote_is_kept(spark):
    assert parsed(spark, GOOD[len("10.0.0.1"):])[0]["ip"] is None
    assert parsed(spark, GOOD.replace("/a", '/a"b'))[0]["request"] == 'GET /a"b HTTP/1.1'


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        parsed(spark, GOOD, "maybe")


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("[29/Nov/2015:03:50:05 +0000]", "2015-11-29 03:50:05"),
        ("[29/Nov/2015:03:50:05]", None),
        ("[29/Nov/2015:03:50:05 ]", None),
        ("[29/Nov/2015:03:50:05 +0000 ]", "2015-11-29 03:50:05"),
        ("[32/Jan/2015:03:50:05 +0000]", None),
        ("[nonsense +0000]", None),
        ("[ ]", None),
        (None, None),
    ],
)
def test_log_time(spark, text, wanted):
    row = spark.createDataFrame([(text,)], "t STRING").select(al.log_time(F.col("t")).alias("t")).first()
    assert (str(row["t"]) if row["t"] else None) == wanted


@pytest.mark.parametrize(
    "request_, strict, lenient",
    [
        ("GET /a HTTP/1.1", "/a", "/a"),
        ("GET /a HTTP/1.1  ", "/a", "/a"),
        ("GET /a", "[error]", "/a"),
        ("GET  /a HTTP/1.1", "[error]", ""),
        ("-", "[error]", "[error]"),
        ("", "[error]", "[error]"),
        ("   ", "[error]", "[error]"),
    ],
)
def test_url(spark, request_, strict, lenient):
    row = spark.createDataFrame([(request_,)], "r STRING").select(
        al.url_strict(F.col("r")).alias("s"), al.url_lenient(F.col("r")).alias("l")
    ).first()
    assert (row["s"], row["l"]) == (strict, lenient)


def test_status_class(spark):
    codes = ["199", "200", "299", "300", "404", "499", "500", "599", "600", "[error]", None]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i INT, c STRING")
    got = [r[0] for r in frame.orderBy("i").select(al.status_class(F.col("c"))).collect()]
    assert got == ["Other", "Success", "Success", "Other", "Other", "Other", "Failure", "Failure", "Other", "Other", "Other"]


def test_policies(spark):
    lines = spark.createDataFrame([(GOOD,), ("junk",), (GOOD.replace(" HTTP/1.1", ""),)], "line STRING")
    assert sorted(r["url"] for r in logs.url_requests(lines).collect()) == ["/a", "[error]", "[error]"]
    assert sorted(r["agent"] for r in logs.field_or_marker(lines, "agent").collect()) == ["()", "agent x", "agent x"]
    assert sorted(tuple(r)[1:] for r in logs.request_records(lines).collect()) == [
        ("/a", 200, "agent x"), ("/a", 200, "agent x"), ("error", 0, "error"),
    ]
    assert sorted(tuple(r)[1:] for r in logs.visitor_hits(lines).collect()) == [
        ("10.0.0.1", "/a"), ("10.0.0.1", "/a"), ("error", "error"),
    ]
    assert sorted(r["status_class"] for r in logs.classified_lines(lines).collect()) == ["Other", "Success", "Success"]


def test_pattern_runs_once_per_line(spark):
    """A filter on a field must not bring a second evaluation of the pattern."""
    lines = spark.createDataFrame([(GOOD,)], "line STRING")
    frame = logs.parse_access_log(lines, "drop").where("ts IS NOT NULL AND status = '200'").select("agent")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
