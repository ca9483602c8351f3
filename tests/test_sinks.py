from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.rules import null_rules, with_reasons
from tidemark.session import shared_dir, write_through
from tidemark.sinks import layout, tables, zones


def frame(spark, *data, schema="k int, v string, d date"):
    return spark.createDataFrame(data, "k int, v string, d string").withColumn("d", F.to_date("d")) \
        if schema == "k int, v string, d date" else spark.createDataFrame(data, schema)


A = (1, "a", "2024-01-01")
B = (2, "b", "2024-01-02")
C = (3, "c", "2024-01-02")


def kv(df):
    return rows(df, "k", "v")


def test_append_and_replace_date(spark, tmp_path, table_name):
    name, root = table_name("t"), str(tmp_path)
    for _ in range(2):
        tables.append_table(frame(spark, A, B), name, "d", root)
    assert kv(spark.table(name)) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    tables.append_table(frame(spark, C), name, "d", root, mode="replace_date")
    assert kv(spark.table(name)) == [(1, "a"), (1, "a"), (3, "c")]
    wider = frame(spark, A).withColumn("extra", F.lit("x"))
    tables.append_table(wider, name, "d", root)
    assert rows(spark.table(name).filter("extra is not null"), "k", "extra") == [(1, "x")]
    with pytest.raises(ValueError):
        tables.append_table(frame(spark, A), table_name("u"), root=root, mode="replace_date")
    with pytest.raises(ValueError):
        tables.append_table(frame(spark, A), name, "d", root, mode="guess")


def test_reload_keeps_columns_and_stamps_the_time(spark, tmp_path, table_name):
    name = table_name("t")
    tables.reload_table(frame(spark, A, B), name, str(tmp_path))
    tables.reload_table(frame(spark, C).select("d", "v", "k"), name, str(tmp_path))
    got = spark.table(name)
    assert got.columns == ["k", "v", "d", "_loaded_at"] and kv(got) == [(3, "c")]
    assert got.filter("_loaded_at is null").isEmpty()


def test_build_reads_what_it_replaces(spark, tmp_path, table_name):
    name = table_name("t")
    tables.build_table(frame(spark, A, B), name, root=str(tmp_path))
    tables.build_table(spark.table(name).filter("k = 2"), name, root=str(tmp_path))
    assert kv(spark.table(name)) == [(2, "b")]
    tables.build_table(spark.table(name).drop("d"), name, root=str(tmp_path))
    assert spark.table(name).columns == ["k", "v"]


def test_merge_touches_only_its_partitions(spark, tmp_path, table_name):
    name, root = table_name("t"), str(tmp_path)
    tables.merge_table(frame(spark, A, B, C), name, "k", "d", root=root)

    def files(day):
        found = spark.table(name).filter(F.col("d") == day).inputFiles()
        return sorted(f for f in found if day in f)

    before = files("2024-01-01")
    tables.merge_table(frame(spark, (2, "B", "2024-01-02"), (4, "d", "2024-01-03")), name, "k", "d", root=root)
    assert kv(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert files("2024-01-01") == before
    # A key that changes its date leaves the old partition, which is then gone.
    tables.merge_table(frame(spark, (1, "A", "2024-01-03")), name, "k", "d", root=root)
    assert kv(spark.table(name)) == [(1, "A"), (2, "B"), (3, "c"), (4, "d")]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert sorted(parts) == ["d=2024-01-02", "d=2024-01-03"]
    # So does a key that loses its date.
    tables.merge_table(frame(spark, (4, "D", None)), name, "k", "d", root=root)
    assert kv(spark.table(name)) == [(1, "A"), (2, "B"), (3, "c"), (4, "D")]


def test_merge_adds_columns(spark, tmp_path, table_name):
    for part in (None, "d"):
        name = table_name("t")
        tables.merge_table(frame(spark, A, B), name, "k", part, root=str(tmp_path))
        source = frame(spark, B, C).drop("v").withColumn("w", F.lit(1))
        tables.merge_table(source, name, "k", part, root=str(tmp_path))
        got = rows(spark.table(name).fillna({"v": "-", "w": 0}), "k", "v", "w")
        assert got == [(1, "a", 0), (2, "-", 1), (3, "-", 1)]


@pytest.mark.parametrize("part, follows", [(None, False), ("d", False), ("d", True)])
@pytest.mark.parametrize("strategy", ["merge", "delete+insert"])
def test_incremental_table(spark, tmp_path, table_name, strategy, part, follows):
    name = table_name("t")

    def run(*data):
        tables.incremental_table(
            frame(spark, *data), name, "k", "d", strategy, part, root=str(tmp_path),
            partition_follows_ts=follows,
        )

    run(A, B)
    run(A, (2, "B", "2024-01-03"), (5, "old", "2024-01-01"))
    assert kv(spark.table(name)) == [(1, "a"), (2, "B")]
    run(A)
    assert kv(spark.table(name)) == [(1, "a"), (2, "B")]


def test_split_and_views(spark, tmp_path):
    checked = with_reasons(frame(spark, A, (2, None, "2024-01-01")), null_rules(["v"]))
    zones.write_split(checked, f"{tmp_path}/good", f"{tmp_path}/bad")
    assert kv(spark.read.parquet(f"{tmp_path}/good")) == [(1, "a")]
    bad = spark.read.parquet(f"{tmp_path}/bad").first()
    assert bad.k == 2 and bad.reasons == ["null:v"]
    tables.as_view(checked, "checked_rows")
    assert spark.table("checked_rows").count() == 2


def test_cluster_fact_spreads_a_hot_key(spark, tmp_path):
    hot = spark.range(4000).selectExpr("'hot' k", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 900 as int)) ts")
    rest = spark.range(4000).selectExpr("concat('k', id % 50) k", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 900 as int)) ts")
    laid_out = layout.cluster_fact(hot.union(rest), "k", "ts", partitions=8)
    laid_out.write.parquet(f"{tmp_path}/fact")
    stored = spark.read.parquet(f"{tmp_path}/fact")
    assert stored.count() == 8000
    spread = stored.filter("k = 'hot'").select(F.input_file_name()).distinct().count()
    assert spread >= 3


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base) and shared_dir(spark, "x") != shared_dir(spark, "x")
    df = write_through(frame(spark, A, B), "t", ("d",))
    assert kv(df) == [(1, "a"), (2, "b")] and df.schema["d"].dataType.simpleString() == "date"


def test_bucketed_join_moves_no_row(spark, table_name):
    from tidemark.sinks.buckets import SALT, join_buckets, store_buckets

    fact = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("tag"),
        F.col("id").alias("v"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 90 as int))").alias("at"),
    )
    dim = spark.range(35).select(F.concat(F.lit("k"), "id").alias("tag"), F.col("id").alias("size"))
    dim = dim.unionAll(spark.createDataFrame([("hot", 99)], "tag string, size long"))
    f, d = table_name("fact"), table_name("dim")
    store_buckets(fact, dim, "tag", "at", f, d, buckets=8, most_rows=400)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_buckets(spark, f, d, "tag")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount" in plan
        got = sorted((r.v, r.size) for r in joined.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = fact.join(dim, "tag", "left").select("v", "size")
    assert got == sorted((r.v, r.size) for r in want.collect()) and len(got) == 6000
    # The hot key lies in several files, each with at most its part; no task writes a file twice.
    spread = spark.table(f).groupBy(F.input_file_name().alias("file"), "tag").count().filter("tag = 'hot'")
    assert spread.count() >= 3 and spark.table(f).filter("tag = 'hot'").select(SALT).distinct().count() == 5
    assert spark.table(f).select(F.input_file_name()).distinct().count() <= 8
    assert spark.table(d).filter("tag = 'hot'").count() == 5 and spark.table(d).filter("tag = 'k3'").count() == 1


def test_a_load_without_a_partition_rewrites_that_one_alone(spark, tmp_path, table_name):
    name, root = table_name("t"), str(tmp_path)
    tables.merge_table(frame(spark, A, B, (9, "z", None)), name, "k", "d", root=root)
    where = lambda: {str(r.d): r.f for r in spark.table(name).select("d", F.input_file_name().alias("f")).collect()}
    before = where()
    tables.merge_table(frame(spark, (9, "Z", None), (5, "new", None)), name, "k", "d", root=root)
    assert kv(spark.table(name)) == [(1, "a"), (2, "b"), (5, "new"), (9, "Z")]
    after = where()
    assert all(after[day] == before[day] for day in ("2024-01-01", "2024-01-02")) and after["None"] != before["None"]
    tables.append_table(frame(spark, (7, "q", None)), name, "d", root, mode="replace_date")
    assert kv(spark.table(name)) == [(1, "a"), (2, "b"), (7, "q")]


def test_a_passing_catalog_is_refused_on_a_cluster(spark):
    class Conf(dict):
        get = dict.get

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="outlives"):
        tables.require_lasting_catalog(Session)
    for more in ({"spark.master": "local[4]"}, {"spark.master": "yarn", "spark.sql.catalogImplementation": "hive"}):
        Session.conf = Conf(more)
        tables.require_lasting_catalog(Session)
