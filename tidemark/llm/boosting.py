"""Gradient-boosted trees on histograms, kept as flat arrays and walked for many rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: node ``i`` has the children ``2 * i + 1`` and ``2 * i + 2``.

    ``feature`` and ``threshold`` are (trees x inner nodes), ``value`` (trees x leaves);
    a row goes right where its feature is above the threshold.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for each row of ``x``."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 0.3,
    least_weight: float = 0.3,
) -> Trees:
    """Fit trees to 0/1 labels by second-order boosting of the logistic loss.

    Without rows, or with one class only, the result is a constant near that class.
    Rows in the same order give the same trees.
    """
    x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
    n, width = x.shape
    base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    inner = 2**depth - 1
    features, thresholds, values = [], [], []
    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        coded = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
        span = max(len(c) for c in cuts) + 1
        useful = [f for f in range(width) if coded[:, f].any()]
        score = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = p - y, p * (1 - p)
            feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
            node = np.zeros(n, dtype=np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                local = node - first
                best = np.full(count, 1e-6)
                for f in useful:
                    slot = local * span + coded[:, f]
                    g = np.bincount(slot, grad, count * span).reshape(count, span)
                    h = np.bincount(slot, hess, count * span).reshape(count, span)
                    gl, hl = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
                    gt, ht = g.sum(axis=1)[:, None], h.sum(axis=1)[:, None]
                    gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                    gain[(hl < least_weight) | (ht - hl < least_weight)] = -1
                    gain = gain[:, : len(cuts[f])]
                    if not gain.shape[1]:
                        continue
                    k = gain.argmax(axis=1)
                    top = gain[np.arange(count), k]
                    better = np.flatnonzero(top > best)
                    best[better] = top[better]
                    feature[first + better] = f
                    threshold[first + better] = cuts[f][k[better]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
            leaf = node - inner
            g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
            value = -rate * g / (h + ridge)
            score += value[leaf]
            features.append(feature)
            thresholds.append(threshold)
            values.append(value)
    shape = (len(features), inner)
    return Trees(
        np.array(features, dtype=np.int64).reshape(shape),
        np.array(thresholds).reshape(shape),
        np.array(values).reshape(len(values), inner + 1),
        base,
    )
