"""Samples bounded whatever the keys, and clashing names in every operator that keeps columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import chat, mixing, neardup, url_rules
from tidemark.llm.sampling import bounded_sample, unused


def test_samples_never_exceed_their_bound(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7).alias("x"))
    assert bounded_sample(df, F.col("id"), 5000).count() == 5000
    sizes = [bounded_sample(df, F.col("id"), n).count() for n in (100, 1000, 4999)]
    assert all(0.7 * n <= s <= n for s, n in zip(sizes, (100, 1000, 4999)))
    same = [sorted(bounded_sample(df.repartition(p), F.col("id"), 300).collect()) for p in (1, 7)]
    assert same[0] == same[1]
    assert bounded_sample(df.limit(0), F.col("id"), 10).count() == 0


def test_a_repeated_key_does_not_break_the_bound(spark):
    hot = spark.range(4000).select(F.lit(7).cast("long").alias("id")).unionAll(spark.range(8000).select("id"))
    got = bounded_sample(hot, F.col("id"), 500)
    assert 250 <= got.count() <= 500 and got.filter("id = 7").count() == 0


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "row int, _ROW int, `a.b` int")
    assert not {n.lower() for n in unused(df, "row", "x")} & {c.lower() for c in df.columns}


def test_mix_keeps_columns_of_any_name(spark, frame):
    rows = [(k, "w " * (k % 40), "ab"[k % 2], k, f"r{k}", "b", "x", 5) for k in range(120)]
    table = frame(rows, "doc_id long, text string, source string, _row long, ROW string, _blocks string, `_words.x` string, position int")
    out = mixing.mixed_documents(table, block_words=8, shards=3)
    assert out.columns == table.columns
    got = out.collect()
    assert got and all(r["_row"] == r.doc_id and r["ROW"] == f"r{r.doc_id}" and r["_blocks"] == "b" for r in got)
    assert mixing.mixed_documents(table.limit(0), shards=3).count() == 0


def test_the_tree_decides_the_shards_and_not_what_is_taken(spark, frame):
    rows = [(k, "w " * (37 * k % 400), "abc"[k % 3]) for k in range(200)]
    table = frame(rows, "doc_id long, text string, source string")
    taken, shards = [], []
    for seed in (1, 2):
        _, draws = mixing.mix_sources(table, shards=5, block_words=16, tree_seed=seed)
        taken.append(sorted(map(tuple, draws.groupBy("id").agg(F.sum("words")).collect())))
        shards.append(sorted(map(tuple, draws.select("id", "block", "round", "shard").collect())))
        per_shard = [r["count"] for r in draws.groupBy("shard").count().collect()]
        assert max(per_shard) - min(per_shard) <= 1
    assert taken[0] == taken[1] and shards[0] != shards[1]


def test_urls_with_clashing_names(spark, frame):
    pages = frame([(1, "http://a.org/x", 1, "h", "p", 2)], "page_id long, url string, _url int, Host string, PATH string, Verdict int")
    rules = frame([("org", "", "block")], "host string, path string, verdict string")
    got = url_rules.judge_urls(pages, rules)
    assert got.columns == ["page_id", "url", "_url", "host", "path", "rule", "verdict"]
    assert [tuple(r) for r in got.collect()] == [(1, "http://a.org/x", 1, "a.org", "/x", "org", "block")]


def test_many_urls_of_one_place(spark, frame):
    pages = frame([(k, f"http://a.org/search?q={k}") for k in range(3000)] + [(9000, "http://a.org/" + "y" * 300_000)], "page_id long, url string")
    rules = frame([("org", "/se", "block")], "host string, path string, verdict string")
    got = url_rules.judge_urls(pages, rules)
    assert got.filter("verdict = 'block'").count() == 3000 and got.filter("verdict = 'allow'").count() == 1


def test_labels_and_ids_of_text(spark, frame):
    rows = [(1, [1.0, 0.0], "cat"), (2, [1.0, 0.0], "cat"), (3, [1.0, 0.0], "dog"), (4, [1.0, 0.0], None)]
    got = neardup.near_duplicates(frame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {r.vec_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 4}
    turns = frame([("c-1", 0, "user", "a"), ("c-1", 1, "assistant", "b"), (None, 0, "user", "x")], "conv_id string, turn long, role string, text string")
    got = {r.conv_id: r.valid for r in chat.format_conversations(turns).collect()}
    assert got == {"c-1": True, None: False}
