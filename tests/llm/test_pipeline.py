"""The stages of the pipeline on planted documents, each against what it must keep."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline as pipeline
from tests.llm.test_decontaminate import brute
from tests.llm.test_group_matrix import all_pairs
from tests.llm.test_words import plain

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, each stage run on what the one before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        rows = docs.collect()
        out.append(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_columns(stages):
    assert len(pipeline.STAGES) == 5
    for rows in stages[:5]:
        assert rows and rows[0].__fields__ == COLUMNS
    assert "doc_id" in stages[5][0].__fields__


def test_quality(stages):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    kept = {r.doc_id for r in stages[1]}
    wrong = [d for d, q in labels.items() if (d in kept) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)


def test_groups(stages):
    want = {i for i, _, c in all_pairs([(r.doc_id, r.text) for r in stages[1]], 5, 80) if i == c}
    assert {r.doc_id for r in stages[2]} == want


def test_benchmark(stages):
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    dropped = [r for r in stages[2] if r.doc_id not in {x.doc_id for x in stages[3]}]
    assert dropped
    assert {d for d, _ in brute([(r.doc_id, r.text) for r in dropped], items)} == {r.doc_id for r in dropped}
    held = [r for r in stages[3] if any(t.lower() in r.text.lower() for _, t in items)]
    assert not held


def test_mix(stages):
    sizes, mixed = ({} for _ in range(2))
    for rows, sums in ((stages[3], sizes), (stages[4], mixed)):
        for r in rows:
            sums[r.doc_id] = sums.get(r.doc_id, 0) + len(plain(r.text))
    assert sum(mixed.values()) == pytest.approx(1.5 * sum(sizes.values()), abs=20)
    assert set(mixed) <= set(sizes) and all(mixed[d] <= 2 * sizes[d] for d in mixed)


def test_shards(stages):
    sizes = {}
    for r in stages[5]:
        sizes.setdefault(r.shard, []).append(r.size)
    assert sorted(r.size for r in stages[5]) == sorted(len(r.text.encode()) + 1 for r in stages[4])
    total = sum(map(sum, sizes.values()))
    assert len(sizes) == 8 and all(abs(sum(s) * 8 / total - 1) < 0.1 for s in sizes.values())


def test_run(spark, stages):
    assert pipeline.run(spark, FOLDER).count() == len(stages[5])
