"""Targets, exact draws from the hypergeometric distribution, and what a mix takes."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.queries import op7_mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, row long, shard string, target string"


def plain_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        for s in over or list(free):
            out[s] = most * sizes[s] if over else level * weight[s]
            left -= out[s]
            free.discard(s)
    return out


@pytest.mark.parametrize("total,marked,drawn", [(50, 20, 10), (900, 300, 450), (7, 7, 3), (5, 0, 2), (6, 6, 6), (1, 1, 1), (0, 0, 0)])
def test_draws_invert_the_distribution(spark, total, marked, drawn):
    def upto(k):
        ways = [math.comb(marked, i) * math.comb(total - marked, drawn - i) for i in range(max(0, drawn + marked - total), k + 1)]
        return sum(ways) / math.comb(total, drawn)

    draw = mixing.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), F.col("u"))
    for r in spark.range(64).select(((F.col("id") + 0.5) / 64).alias("u")).select("u", draw.alias("k")).collect():
        assert max(0, drawn + marked - total) <= r.k <= min(drawn, marked)
        assert upto(r.k) > r.u - 1e-9
        assert upto(r.k - 1) <= r.u + 1e-9


def test_tree_splits_quotas_exactly(spark):
    quotas = spark.createDataFrame([(1, 1000), (2, 37), (3, 0), (4, 1)], "source_no int, quota long")
    got = mixing.split_quotas(quotas, 5, 3).toPandas()
    assert got.groupby("source_no")["quota"].sum().to_dict() == {1: 1000, 2: 37, 3: 0, 4: 1}
    assert got.groupby("shard")["quota"].sum().between(207, 208).all()
    for _, s in got.sort_values("shard").groupby("source_no"):
        assert list(s["before"]) == [0, *np.cumsum(s["quota"])[:-1]]


def docs(frame):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(600):
        source = "hot" if k % 3 == 0 else [None, "a", "b", "é", "z", ""][k % 6]
        rows.append((k, "w " * int(rng.pareto(1.2) * 40), source, 1, 2, "s", "t"))
    rows += [(1000, None, "a", None, None, None, None), (1001, "", "none", 0, 0, "", ""), (5, rows[5][1], rows[5][2], 0, 0, "", ""), (None, "x y", "a", 0, 0, "", "")]
    return rows, frame(rows, SCHEMA)


def test_mix(spark, frame):
    rows, table = docs(frame)
    known, draws = mixing.mix_sources(table, shards=6, block_words=16)
    known, draws = known.toPandas(), draws.toPandas()
    assert len(known) == len(rows)
    known["source"] = known["source"].where(known["source"].notna(), None)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = plain_targets(sizes)
    for r in known.itertuples():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    taken = draws.groupby("row")["words"].sum()
    size = known.set_index("row")["size"]
    assert (taken <= 2 * size[taken.index]).all()
    by_source = draws.assign(source=draws["source"].fillna("\0")).groupby("source")["words"].sum()
    for s, t in want.items():
        assert abs(by_source.get("\0" if s is None else s, 0) - t) <= 0.51
    assert not draws.duplicated(["row", "block", "round"]).any()
    per_shard = draws.groupby("shard").size()
    assert len(per_shard) == 6 and per_shard.max() - per_shard.min() <= 1


def test_mixed_documents(spark, frame):
    rows, table = docs(frame)
    out = mixing.mixed_documents(table, block_words=16, shards=4)
    assert out.columns == table.columns
    got = out.select("doc_id", "text", "n_chars", F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("w")).collect()
    sizes = [len((t or "").split()) for _, t, *_ in rows]
    assert abs(sum(r.w for r in got) - 1.5 * sum(sizes)) < 8
    assert all(r.n_chars == len(r.text) and r.w > 0 for r in got)


def test_reruns_agree_and_empty(spark, frame):
    folder = "/root/testdata/sf0.001"
    first, second = ({r.doc_id: r.taken for r in op7_mixing(spark, folder).collect()} for _ in range(2))
    assert first == second
    known, draws = mixing.mix_sources(frame([], SCHEMA))
    assert known.count() == 0 and draws.count() == 0


def test_query_counts_words(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())
    got = op7_mixing(spark, folder).collect()
    assert {r.doc_id: r.size for r in got} == {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in texts.items()}
    assert all(0 <= r.taken <= 2 * r.size for r in got)


def test_plan_has_no_python(spark):
    plan = op7_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
