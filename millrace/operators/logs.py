"""Access-log lines to typed columns, and the projections the log jobs use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import access_log as al

ALL_FIELDS = tuple("ts" if name == "date_time" else name for name in al.FIELDS)
_PARTS = "_parts"


def parse_access_log(
    lines: DataFrame, unmatched: str = "keep", line: str = "line", fields: Sequence[str] = ALL_FIELDS
) -> DataFrame:
    """Add ``matched`` and the wanted fields (``ts`` and eight texts, all unless named) to every line.

    ``unmatched='drop'`` removes lines that do not match, ``'keep'`` leaves them with NULL fields.
    A matching line without an address has a NULL ``ip``.

    The pattern runs once per line, and only wanted fields are copied out of it.  Its result goes
    through a one-element ``explode`` because Catalyst does not move filters on derived columns below
    a generator; without it, every filter on a field (the time filter of a window, say) would run
    the pattern a second time.
    """
    if unmatched not in ("keep", "drop"):
        raise ValueError(f"unmatched must be 'keep' or 'drop', not {unmatched!r}")
    groups = ["date_time" if name == "ts" else name for name in fields]
    source = F.col(line)
    exploded = lines.select("*", F.explode(F.array(al.field_array(source, groups))).alias(_PARTS))
    matched = al.is_field_array(F.col(_PARTS), source, groups)
    if unmatched == "drop":
        exploded = exploded.where(matched)
        matched = F.lit(True)
    columns = []
    for i, name in enumerate(fields):
        value = F.get(_PARTS, F.lit(i + 1))
        if unmatched == "keep":
            value = F.when(matched, value)
        if name == "ts":
            value = al.log_time(value)
        elif name == "ip":
            value = F.nullif(value, F.lit(""))
        columns.append(value.alias(name))
    return exploded.select(*lines.columns, matched.alias("matched"), *columns)


def url_requests(lines: DataFrame) -> DataFrame:
    """``url`` per line by the strict rule; lines that do not match count under the bad-URL marker."""
    parsed = parse_access_log(lines, fields=["request"])
    url = F.when(F.col("matched"), al.url_strict(F.col("request"))).otherwise(F.lit(al.BAD_URL))
    return parsed.select(*lines.columns, url.alias("url"))


# Fixed value: the key under which lines without an agent or referrer are counted.
NO_FIELD = "()"


def field_or_marker(lines: DataFrame, field: str) -> DataFrame:
    """``agent`` or ``referer`` per line; lines that do not match are counted under a marker."""
    parsed = parse_access_log(lines, fields=[field])
    value = F.when(F.col("matched"), F.col(field)).otherwise(F.lit(NO_FIELD))
    return parsed.select(*lines.columns, value.alias(field))


def request_records(lines: DataFrame) -> DataFrame:
    """``(url, status, agent)`` per line; lines that do not match become ``('error', 0, 'error')``."""
    parsed = parse_access_log(lines, fields=["request", "status", "agent"])
    ok = F.col("matched")
    return parsed.select(
        *lines.columns,
        F.when(ok, al.url_lenient(F.col("request"))).otherwise(F.lit("error")).alias("url"),
        F.when(ok, al.status_int(F.col("status"))).otherwise(F.lit(0)).alias("status"),
        F.when(ok, F.col("agent")).otherwise(F.lit("error")).alias("agent"),
    )


def visitor_hits(lines: DataFrame) -> DataFrame:
    """``(ip, url)`` per line; all lines that do not match share the visitor ``error``."""
    parsed = parse_access_log(lines, fields=["ip", "request"])
    ok = F.col("matched")
    return parsed.select(
        *lines.columns,
        F.when(ok, F.col("ip")).otherwise(F.lit("error")).alias("ip"),
        F.when(ok, al.url_lenient(F.col("request"))).otherwise(F.lit("error")).alias("url"),
    )


def classified_lines(lines: DataFrame) -> DataFrame:
    """``status_class`` per line; lines that do not match are neither success nor failure."""
    parsed = parse_access_log(lines, fields=["status"])
    return parsed.select(*lines.columns, al.status_class(F.col("status")).alias("status_class"))


def count_by_agent_sql(records: DataFrame, view: str = "requests") -> DataFrame:
    """Requests per agent, asked in SQL over a view of the batch."""
    records.createOrReplaceTempView(view)
    return records.sparkSession.sql(f"SELECT agent, count(*) AS total FROM {view} GROUP BY agent")
