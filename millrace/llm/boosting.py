"""Small numpy learners: boosted trees with logistic loss, isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """A complete binary tree stored by level: ``feature[i]``, ``cut[i]`` (go right if above), ``leaf`` values."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        inner = len(self.feature)
        while inner and at[0] < inner:
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.cut[at])
        return self.leaf[at - inner]


@dataclass
class Boosted:
    """A sum of trees for the log-odds of label 1."""

    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += tree.predict(x)
        return out


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 32, damping: float = 1.0) -> Boosted:
    """Newton boosting on binned features; every split is the best over all features and bin edges."""
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    model = Boosted(float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(column[column != column.min()] if np.ptp(column) else column, np.linspace(0, 1, bins + 1)[:-1])) for column in x.T]
    edges = [np.unique(np.append(e, column.min())) for e, column in zip(edges, x.T, strict=True)]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], 1)
    width, features, score, inner = bins + 3, x.shape[1], np.full(len(y), model.start), 2**depth - 1
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = chance - y, chance * (1 - chance)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        cut_bin = np.full(inner, width, np.int64)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            if len(here) >= 2:
                flat = (binned[here] + np.arange(features) * width).ravel()
                shape = (features, width)
                g = np.bincount(flat, np.repeat(slope[here], features), features * width).reshape(shape).cumsum(1)
                h = np.bincount(flat, np.repeat(bend[here], features), features * width).reshape(shape).cumsum(1)
                gain = g**2 / (h + damping) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + damping) - g[:, -1:] ** 2 / (h[:, -1:] + damping)
                f, b = np.unravel_index(np.argmax(gain), shape)
                if gain[f, b] > 1e-9 and b < len(edges[f]):
                    feature[node], cut[node], cut_bin[node] = f, edges[f][b], b
            at[here] = 2 * node + 1 + (binned[here, feature[node]] > cut_bin[node])
        leaves = np.bincount(at - inner, -slope, inner + 1) / (np.bincount(at - inner, bend, inner + 1) + damping) * rate
        score += leaves[at - inner]
        model.trees.append(Tree(feature, cut, leaves))
    return model


def unseen_raw(x: np.ndarray, y: np.ndarray, folds: int) -> np.ndarray:
    """Raw scores of every row by trees fitted on the other folds; classes are spread evenly over the folds.

    A fold that leaves no row to learn from has raw score 0.
    """
    fold = np.empty(len(y), np.int64)
    fold[np.argsort(y, kind="stable")] = np.arange(len(y)) % folds
    raw = np.zeros(len(y))
    for own in np.unique(fold):
        held = fold == own
        if not held.all():
            raw[held] = fit_boosted(x[~held], y[~held]).raw(x[held])
    return raw


@dataclass
class Isotonic:
    """A rising step function from raw scores to chances, straight between its points."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.at, self.value)


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; rows of equal raw score are one point.  Ends are drawn in by one half row."""
    at, group = np.unique(raw, return_inverse=True)
    weight = np.bincount(group).astype(float)
    blocks: list[list[float]] = []  # mean, weight, points
    for mean, w in zip(np.bincount(group, y) / weight, weight, strict=True):
        blocks.append([mean, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w2, k = blocks.pop()
            total = blocks[-1][1] + w2
            blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + m * w2) / total, total, blocks[-1][2] + k]
    value = np.concatenate([np.full(k, (m * w + 0.5 * y.mean()) / (w + 0.5)) for m, w, k in blocks])
    return Isotonic(at, np.maximum.accumulate(value))
