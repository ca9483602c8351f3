"""Nearest points of the E8 lattice, and cells of vectors in several random projections."""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import mix

_CHOICES = (
    # Which of the coordinates nearest to a tie go to their other neighbour: for an even sum, for an odd one.
    ((), (0, 1), (0, 2), (1, 2)),
    ((0,), (1,), (2,), (0, 1, 2)),
)


def nearest_points(x: np.ndarray, count: int) -> np.ndarray:
    """The nearest E8 points of each row of ``x`` (rows x 8), doubled to integers: rows x count x 8.

    E8 is D8, the integer points with an even sum, and D8 moved by a half. In each of
    the two, the coordinates are rounded and those nearest to a tie changed until the
    sum is even; the first point is the nearest of all, the others are near ones,
    at most 8 in all.
    """
    points, costs = [], []
    for half in (0.0, 0.5):
        base = np.rint(x - half)
        error = x - half - base
        toward = np.where(error >= 0, 1, -1)
        price = 1 - 2 * np.abs(error)
        ties = np.argsort(price, axis=1, kind="stable")[:, :3]
        price = np.take_along_axis(price, ties, axis=1)
        odd = base.sum(axis=1).astype(np.int64) & 1
        far = (error**2).sum(axis=1)
        for even_set, odd_set in zip(*_CHOICES):
            point = base.copy()
            cost = far.copy()
            for parity, chosen in ((0, even_set), (1, odd_set)):
                rows = np.flatnonzero(odd == parity)
                for j in chosen:
                    at = ties[rows, j]
                    point[rows, at] += toward[rows, at]
                    cost[rows] += price[rows, j]
            points.append((2 * (point + half)).astype(np.int32))
            costs.append(cost)
    order = np.argsort(np.stack(costs, axis=1), axis=1, kind="stable")[:, :count]
    return np.take_along_axis(np.stack(points, axis=1), order[:, :, None], axis=1)


class Tables:
    """Random projections of unit vectors, ``blocks`` lattice points for each table."""

    def __init__(self, dimension: int, tables: int, blocks: int, probes: int, scale: float, seed: int = 11) -> None:
        rng = np.random.default_rng([seed, dimension])
        self.tables, self.blocks, self.probes = tables, blocks, probes
        self.scale = scale * np.sqrt(dimension)
        width = 8 * blocks
        self.axes = []
        for _ in range(tables):
            draw = rng.standard_normal((dimension, max(width, 1)))
            self.axes.append(np.linalg.qr(draw)[0] if width <= dimension else draw / np.linalg.norm(draw, axis=0))

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x tables) home cells and (rows x tables x blocks * probes) neighbouring cells, as hashes."""
        homes, near = [], []
        for t, axes in enumerate(self.axes):
            y = unit @ axes * self.scale
            codes = []
            for b in range(self.blocks):
                points = nearest_points(y[:, 8 * b : 8 * b + 8], 1 + self.probes)
                code = np.full(points.shape[:2], (t * 64 + b + 1) * 0x9E3779B9, dtype=np.uint64)
                for k in range(8):
                    code = mix(code ^ points[:, :, k].astype(np.int64).view(np.uint64))
                codes.append(code)
            total = sum(c[:, 0] for c in codes)
            homes.append(mix(total))
            near.append(np.stack([mix(total - c[:, 0] + c[:, p]) for c in codes for p in range(1, 1 + self.probes)], axis=1))
        return np.stack(homes, axis=1).view(np.int64), np.stack(near, axis=1).view(np.int64)
