"""K-means updated batch by batch, with older batches forgotten at a chosen rate."""

from __future__ import annotations

import random
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.vectors import nearest_centre

# A cluster lighter than this share of the heaviest one is dying, and the two halves
# of a split cluster are moved apart by this share of each coordinate.
DYING_SHARE = 1e-8
SPLIT_SHARE = 1e-14


@dataclass(frozen=True)
class KMeansModel:
    """``k`` centres and the weight behind each; small and independent of the data size."""

    centres: tuple[tuple[float, ...], ...]
    weights: tuple[float, ...]

    @property
    def dim(self) -> int:
        return len(self.centres[0])


def random_centres(k: int, dim: int, weight: float = 0.0, seed: int = 0) -> KMeansModel:
    """Standard normal starting centres."""
    rng = random.Random(seed)
    centres = tuple(tuple(rng.gauss(0.0, 1.0) for _ in range(dim)) for _ in range(k))
    return KMeansModel(centres, (weight,) * k)


def assign(points: DataFrame, model: KMeansModel, features: str = "features") -> DataFrame:
    """Add ``cluster``, the position of the nearest centre."""
    return points.withColumn("cluster", nearest_centre(features, model.centres))


def batch_sums(points: DataFrame, model: KMeansModel, features: str = "features") -> DataFrame:
    """``(cluster, n, total)`` for the batch: at most ``k`` rows, summed before the shuffle."""
    totals = F.expr("array(" + ", ".join(f"sum(get(`{features}`, {i}))" for i in range(model.dim)) + ")")
    return (
        assign(points.select(features), model, features)
        .where("cluster IS NOT NULL")  # vectors of another length belong nowhere
        .groupBy("cluster")
        .agg(F.count("*").alias("n"), totals.alias("total"))
    )


def merge(model: KMeansModel, sums: Iterable, decay: float = 1.0, per_point: bool = False) -> KMeansModel:
    """The model after a batch whose ``(cluster, n, total)`` rows are given.

    ``decay`` scales old weights once per batch, or once per new point with ``per_point``.
    """
    rows = [row for row in sums if row["n"]]
    factor = decay ** sum(row["n"] for row in rows) if per_point else decay
    weights = [w * factor for w in model.weights]
    centres = [list(c) for c in model.centres]
    for row in rows:
        at, count = row["cluster"], row["n"]
        weights[at] += count
        share = count / max(weights[at], 1e-16)
        centres[at] = [(1.0 - share) * c + share * (t / count) for c, t in zip(centres[at], row["total"])]
    heavy = max(range(len(weights)), key=weights.__getitem__)
    light = min(range(len(weights)), key=weights.__getitem__)
    if weights[light] < DYING_SHARE * weights[heavy]:
        weights[heavy] = weights[light] = (weights[heavy] + weights[light]) / 2.0
        shifts = [SPLIT_SHARE * max(abs(c), 1.0) for c in centres[heavy]]
        whole = centres[heavy]
        centres[heavy] = [c + s for c, s in zip(whole, shifts)]
        centres[light] = [c - s for c, s in zip(whole, shifts)]
    return KMeansModel(tuple(map(tuple, centres)), tuple(weights))


def update(
    model: KMeansModel, points: DataFrame, features: str = "features", decay: float = 1.0, per_point: bool = False
) -> KMeansModel:
    """One batch of training: one pass over the points, ``k`` rows to the driver."""
    return merge(model, batch_sums(points, model, features).collect(), decay, per_point)


def label_agreement(assigned: DataFrame, label: str = "label") -> DataFrame:
    """How often each known label met each cluster; cluster numbers need not equal labels."""
    return assigned.groupBy(F.col(label).cast("int").alias("label"), "cluster").agg(F.count("*").alias("n"))
