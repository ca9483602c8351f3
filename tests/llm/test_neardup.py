"""Lattice points against all points near, links against all pairs."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from tidemark.llm import neardup
from tidemark.llm.lattice import nearest_points
from tidemark.llm.queries import op5_embedding_near_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, row long, n_links string, cls string"


def test_nearest_of_all_lattice_points():
    x = np.random.default_rng(0).normal(size=(40, 8)) * 2
    near = nearest_points(x, 4)
    corners = np.array(list(itertools.product((0, 1), repeat=8)))
    for v, points in zip(x, near):
        best = math.inf
        for half in (0, 0.5):
            whole = np.floor(v - half) + corners
            best = min(best, ((whole[whole.sum(axis=1) % 2 == 0] + half - v) ** 2).sum(axis=1).min())
        far = ((points / 2 - v) ** 2).sum(axis=1)
        assert far[0] == np.float64(far[0]) and abs(far[0] - best) < 1e-9
        assert (np.diff(far) >= -1e-9).all() and len({tuple(p) for p in points}) == 4
        assert all((p % 2 == p[0] % 2).all() and (p - p[0] % 2).sum() % 4 == 0 for p in points)


def all_pairs(rows, cosine=0.98):
    units = []
    for _, v, label, *_ in rows:
        ok = label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        a = np.array(v, dtype=np.float32).astype(float) if ok else None
        units.append(a / np.sqrt(a @ a) if ok else None)
    links = {k: set() for k in range(len(rows))}
    for a, b in itertools.combinations(range(len(rows)), 2):
        if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]):
            if units[a] @ units[b] >= cosine:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        least = min(ids, default=None)
        out.append((rows[k][0], len(links[k]), least, rows[k][0] is not None and least == rows[k][0]))
    return sorted(map(str, out))


def vectors(seed=0, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(250):
        v = rng.normal(size=size)
        for _ in range(rng.integers(1, 4)):
            rows.append([*(v + rng.normal(size=size) * 0.05 * np.sqrt(rng.random()))])
    hub = rng.normal(size=size)
    rows += [[*(hub + rng.normal(size=size) * 0.08)] for _ in range(120)] + [[*hub]] * 60
    table = [(k, [float(np.float32(c)) for c in v], int(k % 2) if k % 7 else 1) for k, v in enumerate(rows)]
    table += [(900 + i, v, 1) for i, v in enumerate([None, [], [0.0] * size, [float("nan")] * size, [float("inf")] + [1.0] * (size - 1), [None] + [1.0] * (size - 1), [1.0, 2.0], [2.0, 4.0]])]
    table += [(950, table[0][1], None), (None, table[-20][1], table[-20][2]), table[5], (951, [c * 3 for c in table[5][1]], table[5][2])]
    return [(*r, 0, "", "") for r in table]


def test_against_all_pairs(spark, frame, monkeypatch):
    rows = vectors()
    want = all_pairs(rows)
    table = frame(rows, SCHEMA)
    assert sorted(map(str, map(tuple, neardup.near_duplicates(table).collect()))) == want
    monkeypatch.setattr(neardup, "TILE", 8)
    assert sorted(map(str, map(tuple, neardup.near_duplicates(table).collect()))) == want


def test_empty(spark, frame):
    assert neardup.near_duplicates(frame([], SCHEMA)).count() == 0
    got = neardup.near_duplicates(frame([(3, None, None, 0, "", "")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(3, 0, 3, True)]


def test_query_against_all_pairs(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{folder}/embeddings.parquet'").fetchall()
    got = sorted(map(str, map(tuple, op5_embedding_near_dedup(spark, folder).collect())))
    assert got == all_pairs(rows)


@pytest.mark.parametrize("width", [16, 64, 256, 768])
def test_planted_pairs_meet(spark, frame, width):
    """Pairs with a cosine of 0.98 to 0.995 come together in some lattice cell, in few and in many dimensions."""
    rng = np.random.default_rng(width)
    rows, pairs = [], 250
    for k in range(pairs):
        a = rng.normal(size=width)
        a /= np.linalg.norm(a)
        b = rng.normal(size=width)
        b -= a * (a @ b)
        cosine = rng.uniform(0.98, 0.995)
        b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), 1), (2 * k + 1, (3 * b).tolist(), 1)]
    got = {r.vec_id: r for r in neardup.near_duplicates(frame(rows, "vec_id long, embedding array<double>, label long")).collect()}
    met = sum(got[2 * k + 1].component_id == 2 * k for k in range(pairs))
    assert met >= 0.99 * pairs
    assert all(r.n_links <= 1 for r in got.values()) or width == 16
