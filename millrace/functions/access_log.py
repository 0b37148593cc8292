"""Expressions over one line of a combined-format web access log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import split_space

# The line pattern, its nine groups, the time format, the status classes and the
# markers for unusable values.  Results depend on each of them.
ACCESS_LOG_PATTERN = (
    r"^(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "
    r'"(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"\z'
)
FIELDS = ("ip", "client", "user", "date_time", "request", "status", "bytes", "referer", "agent")
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
SUCCESS, FAILURE, OTHER = "Success", "Failure", "Other"
BAD_URL = "[error]"

# No captured group can hold a line feed ('.' and '\S' both exclude it), so it separates the nine
# groups without any chance of colliding with their content.
_SEPARATOR = "\n"


def field_array(line: Column, fields: Sequence[str] = FIELDS) -> Column:
    """The wanted fields of a matching line after a leading empty entry, from one evaluation of the pattern."""
    groups = "".join(f"{_SEPARATOR}${FIELDS.index(name) + 1}" for name in fields)
    return F.split(F.regexp_replace(line, ACCESS_LOG_PATTERN, groups), _SEPARATOR)


def is_field_array(parts: Column, line: Column, fields: Sequence[str] = FIELDS) -> Column:
    """Whether ``parts`` came from a matching line; a line with a line feed never matches."""
    whole = F.size(parts) == len(fields) + 1
    return F.coalesce(whole & ~F.contains(line, F.lit(_SEPARATOR)), F.lit(False))


def log_time(date_time: Column) -> Column:
    """``[29/Nov/2015:03:50:05 +0000]`` as a timestamp; the zone part is required but not applied.

    Text that is no valid time gives NULL.
    """
    space = F.instr(date_time, " ")
    stamp = date_time.substr(F.lit(2), space - 2)
    # at least one character has to stand between the first space and the closing bracket
    has_zone = space.between(F.lit(2), F.length(date_time) - 2)
    return F.when(has_zone, F.try_to_timestamp(stamp, F.lit(LOG_TIME_FORMAT)))


def url_strict(request: Column) -> Column:
    """Second token of a request of exactly three tokens, otherwise the bad-URL marker."""
    tokens = split_space(request)
    return F.when(F.size(tokens) == 3, F.get(tokens, F.lit(1))).otherwise(F.lit(BAD_URL))


def url_lenient(request: Column) -> Column:
    """Second token of a request if there is one, otherwise the bad-URL marker."""
    return F.coalesce(F.get(split_space(request), F.lit(1)), F.lit(BAD_URL))


def status_int(status: Column) -> Column:
    return status.try_cast("int")


def status_class(status: Column) -> Column:
    """2xx is a success, 5xx a failure, everything else (also text) neither."""
    code = F.coalesce(status_int(status), F.lit(0))
    return (
        F.when(code.between(200, 299), F.lit(SUCCESS))
        .when(code.between(500, 599), F.lit(FAILURE))
        .otherwise(F.lit(OTHER))
    )
