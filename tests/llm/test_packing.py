"""Shards: everything placed once, sizes near equal, slots without gaps."""

from __future__ import annotations

import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import packing

SCHEMA = "doc_id long, text string, shard int, bytes long, piece string"


@given(st.integers(1, 60), st.integers(2, 8), st.integers(0, 9))
def test_pieces_go_where_the_product_is_highest(n, shards, seed):
    sizes = np.random.default_rng(seed).random((n, 3))
    sizes /= sizes.sum(axis=0)
    residual = np.full((shards, 3), 1 / shards)
    out = packing.place(sizes, residual.copy())
    left = residual.copy()
    for i in sorted(range(n), key=lambda i: -sizes[i].max()):
        products = left @ sizes[i]
        assert products[out[i]] == products.max()
        left[out[i]] -= sizes[i]


def test_law(spark, frame):
    rng = np.random.default_rng(2)
    rows = [(k, "w " * int(s), 1, 2, "p") for k, s in enumerate(rng.pareto(1.5, 3000) * 20 + 1)]
    rows += [(k, "one and the same text", 1, 2, "p") for k in range(5000, 6500)]
    rows += [(None, None, None, None, None), (7000, "", 0, 0, ""), (None, "x", 0, 0, ""), (1, rows[1][1], 0, 0, ""), (7001, "v " * 3_000, 0, 0, "")]
    got = packing.pack_shards(frame(rows, SCHEMA), 8).toPandas()
    assert len(got) == len(rows)
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted(zip(got["size"], got["text_crc32"])) == want
    for _, shard in got.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() / sums.mean() < 1.03 and sums.min() / sums.mean() > 0.97
    counts = got.groupby("shard").size()
    assert counts.max() < 1.2 * counts.mean()


def test_small_inputs(spark, frame):
    assert packing.pack_shards(frame([], SCHEMA), 4).count() == 0
    got = packing.pack_shards(frame([(1, "a", 0, 0, "")], SCHEMA), 4).collect()
    assert [(r.doc_id, r.size, r.slot) for r in got] == [(1, 2, 0)]
    blank = packing.pack_shards(frame([(k, None, 0, 0, "") for k in range(8)], SCHEMA), 4).collect()
    assert len(blank) == 8


def plain_shards(texts, shards):
    """The shard of every text, all different, by the rule itself: larger ones first, to the highest dot product."""
    sizes = {t: [len(t.encode()) + 1, len(t.split()), 1] for t in texts}
    total = [sum(s[d] for s in sizes.values()) for d in range(3)]
    parts = {t: np.array([s[d] / total[d] for d in range(3)]) for t, s in sizes.items()}
    left = [np.full(3, 1 / shards) for _ in range(shards)]
    out = {}
    for t in sorted(texts, key=lambda t: (-parts[t].max(), zlib.crc32(t.encode()))):
        products = [float(room @ parts[t]) for room in left]
        best = max(range(shards), key=lambda k: (round(products[k], 12), -k))
        out[t] = best
        left[best] = left[best] - parts[t]
    return out


def test_whole_result_against_a_plain_version(spark, frame):
    rng = np.random.default_rng(9)
    texts = [f"t{k} " + "w " * int(s) for k, s in enumerate(rng.pareto(1.3, 150) * 30 + 1)]
    got = packing.pack_shards(frame([(k, t, 0, 0, "") for k, t in enumerate(texts)], SCHEMA), 5).collect()
    want = plain_shards(texts, 5)
    same = sum(r.shard == want[texts[r.doc_id]] for r in got)
    assert len(got) == len(texts) and same == len(texts)
    for k in range(5):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(s == k for s in want.values())))
