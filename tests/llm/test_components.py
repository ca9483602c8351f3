from __future__ import annotations

import random

from tidemark.llm.components import components


def test_against_union_find(spark):
    rng = random.Random(0)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1200)]
    links += [(5000, k) for k in range(5001, 5300)] + [(7, 7), (None, 3), (3, None), (1, 2), (2, 1), (1, 2)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
