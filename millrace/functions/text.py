"""Expressions over free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal digits of the basic multilingual plane: digits outside it take two UTF-16 units and are
# not seen by a per-unit digit test.
_DIGIT = r"[\p{Nd}&&[\x{0}-\x{FFFF}]]"


def split_space(text: Column) -> Column:
    """Tokens between single spaces: trailing empty tokens go, leading and inner ones stay.

    Empty text is one empty token; text of spaces only has no token.
    """
    trimmed = F.rtrim(text)
    only_spaces = (F.octet_length(trimmed) == 0) & (F.octet_length(text) > 0)
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def text_length(text: Column, unit: str = "utf16") -> Column:
    """Length in UTF-16 units (as a JVM string reports it) or in code points."""
    points = F.length(text)
    if unit == "codepoint":
        return points.cast("bigint")
    if unit != "utf16":
        raise ValueError(f"unknown length unit {unit!r}")
    octets = F.octet_length(text)
    units = F.floor(F.octet_length(F.encode(text, "UTF-16BE")) / 2)
    return F.when(octets == points, points.cast("bigint")).otherwise(units.cast("bigint"))


def has_digit(word: Column) -> Column:
    return word.rlike(_DIGIT)


def is_term(word: Column, prefix: str = "$") -> Column:
    """Words that start with the prefix, are longer than one unit and hold no digit."""
    return word.startswith(prefix) & (text_length(word) > 1) & ~has_digit(word)
