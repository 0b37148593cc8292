"""Expressions over dense numeric vectors held as ``array<double>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(value: float) -> str:
    """A double as SQL text; also NaN and infinities, which have no literal."""
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def parse_vector(text: Column) -> Column:
    """``[a,b]`` as an array of doubles; NULL when it is not such a list."""
    return F.from_json(text, "array<double>")


def parse_labeled(text: Column) -> Column:
    """``(label,[a,b])`` or ``label,a b`` as ``struct<label, features>``."""
    nested = r"^\(\s*([^,\[]+?)\s*,\s*(\[.*\])\s*\)$"
    is_nested = text.rlike(nested)
    parts = F.split(text, ",")
    flat = F.transform(F.split(F.trim(F.get(parts, F.lit(1))), " "), lambda x: x.try_cast("double"))
    label = F.when(is_nested, F.regexp_extract(text, nested, 1)).otherwise(F.trim(F.get(parts, F.lit(0))))
    features = F.when(is_nested, parse_vector(F.regexp_extract(text, nested, 2))).otherwise(flat)
    return F.struct(label.try_cast("double").alias("label"), features.alias("features"))


def nearest_centre(features: str, centres: Sequence[Sequence[float]]) -> Column:
    """Position of the centre closest to the vector in column ``features``, the first one on ties.

    NULL for vectors that are NULL, hold a NULL or are not as long as the centres.

    The centres are a model of k x dim numbers, independent of the data size, and travel as literals.
    """
    vectors = ", ".join("array(" + ", ".join(number(v) for v in c) + ")" for c in centres)
    distances = f"""transform(array({vectors}), c ->
        aggregate(zip_with(`{features}`, c, (x, y) -> (x - y) * (x - y)), 0D, (total, d) -> total + d))"""
    best = f"array_min(transform({distances}, (d, i) -> struct(d AS d, i AS i))).i"
    fits = (F.size(features) == len(centres[0])) & ~F.exists(features, lambda x: x.isNull())
    return F.when(F.col(features).isNotNull() & fits, F.expr(best))
