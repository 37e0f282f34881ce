"""Small gradient-boosted trees, fitted on the driver from a bounded table and evaluated as column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, rate: float = 0.3, depth: int = 3, least: int = 8) -> tuple[float, list]:
    """Log-loss boosting: the starting log odds and trees, each (feature, threshold, low, high) or a leaf value."""
    p = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
    start = float(np.log(p / (1 - p)))
    score = np.full(len(y), start)
    trees = []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-score))
        g, h = y - q, q * (1 - q)
        tree = _grow(x, g, h, np.arange(len(y)), depth, least, rate)
        trees.append(tree)
        score += predict([tree], x)
    return start, trees


def _grow(x, g, h, rows, depth, least, rate):
    total_g, total_h = g[rows].sum(), h[rows].sum()
    leaf = float(rate * total_g / (total_h + 1))
    if depth == 0 or len(rows) < 2 * least:
        return leaf
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        order = rows[np.argsort(x[rows, f], kind="stable")]
        v = x[order, f]
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= least) & (cut <= len(rows) - least)]
        if not len(cut):
            continue
        gl, hl = np.cumsum(g[order])[cut - 1], np.cumsum(h[order])[cut - 1]
        gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float((v[cut[k]] + v[cut[k] - 1]) / 2))
    _, f, at = best
    if f is None:
        return leaf
    low = x[rows, f] < at
    return f, at, _grow(x, g, h, rows[low], depth - 1, least, rate), _grow(x, g, h, rows[~low], depth - 1, least, rate)


def predict(trees: list, x: np.ndarray) -> np.ndarray:
    def one(tree, rows):
        if not isinstance(tree, tuple):
            out[rows] += tree
            return
        f, at, low, high = tree
        side = x[rows, f] < at
        one(low, rows[side])
        one(high, rows[~side])

    out = np.zeros(len(x))
    for tree in trees:
        one(tree, np.arange(len(x)))
    return out


def column(start: float, trees: list, features: list[Column]) -> Column:
    """The score (log odds) as a CASE expression over feature columns."""

    def one(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        f, at, low, high = tree
        return F.when(features[f] < F.lit(at), one(low)).otherwise(one(high))

    total = F.lit(start)
    for tree in trees:
        total = total + one(tree)
    return total
