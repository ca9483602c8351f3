"""Tables published by commit: readers, failures, sessions, and merges that read only what they must."""

from __future__ import annotations

import subprocess
import sys
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.sinks import versions
from tidemark.sinks.versions import NO_VALUE, VersionedTable


def frame(spark, *data):
    return spark.createDataFrame(data, "k long, v string, d string").withColumn("d", F.to_date("d"))


def days(spark, each=300, count=8):
    day = F.expr("date_add(date'2024-01-01', cast(id % {} as int))".format(count))
    return spark.range(each * count).select((F.col("id") * 7919 % 100_003).alias("k"), F.lit("old").alias("v"), day.alias("d"))


def folders(table):
    return {p: set(f) for p, f in table.manifest().parts.items()}


def test_replace_append_and_swap(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    assert not t.exists() and t.manifest() is None
    with pytest.raises(FileNotFoundError):
        t.read()
    a, b, c = (1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", None)
    t.replace(frame(spark, a, b, c), "d")
    assert set(t.manifest().parts) == {"2024-01-01", "2024-01-02", NO_VALUE}
    assert t.read().schema.simpleString() == "struct<k:bigint,v:string,d:date>"
    before = folders(t)
    t.append(frame(spark, (4, "d", "2024-01-02")).withColumn("more", F.lit(1)))
    t.swap(frame(spark, (5, "e", None)))
    assert rows(t.read(), "k", "more") == [(1, None), (2, None), (4, 1), (5, None)]
    assert folders(t)["2024-01-01"] == before["2024-01-01"] and before["2024-01-02"] < folders(t)["2024-01-02"]
    t.swap(frame(spark), ["2024-01-02"])
    assert rows(t.read(), "k") == [(1,), (5,)]
    assert rows(t.read(version=1), "k") == [(1,), (2,), (3,)] and t.versions() == [1, 2, 3, 4]
    t.replace(t.read().drop("more", "d"))
    assert rows(t.read()) == [(1, "a"), (5, "e")]
    t.replace(t.read().limit(0))
    assert t.read().columns == ["k", "v"] and t.read().isEmpty()


def test_odd_partition_values(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    data = [(1, "a/b"), (2, "50% = x"), (3, None), (4, "ä:*?"), (5, "plain")]
    t.replace(spark.createDataFrame(data, "k long, p string"), "p", "k")
    assert rows(t.read(), "k") == [(k,) for k in range(1, 6)]
    t.merge(spark.createDataFrame([(1, "a/b"), (2, "plain"), (6, "a/b")], "k long, p string"), "k")
    assert {r.k: r.p for r in t.read().collect()} == {**dict(data), 2: "plain", 6: "a/b"}


def test_readers_never_miss_the_table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    t.replace(days(spark, 50), "d")
    seen, faults, done = set(), [], threading.Event()

    def look():
        while not done.is_set():
            try:
                r = t.read().agg(F.count("*"), F.min("v"), F.max("v")).head()
                seen.add(tuple(r))
            except Exception as e:  # noqa: BLE001 - what a reader meets is what is tested
                faults.append(e)

    reader = threading.Thread(target=look)
    reader.start()
    for k in range(10):
        t.replace(days(spark, 50, 4 + k % 3).withColumn("v", F.lit(f"v{k}")), "d")
    done.set()
    reader.join()
    assert not faults and len(seen) > 1
    # Every look is of one version: all its rows, with one value.
    assert all(low == high and n in (200, 250, 300, 400) for n, low, high in seen)


def test_a_failed_run_changes_nothing(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    t.replace(frame(spark, (1, "a", "2024-01-01")), "d")
    broken = days(spark).withColumn("v", F.when(F.col("k") > 90_000, F.raise_error(F.lit("broken"))).otherwise("x"))
    for job in (lambda: t.replace(broken, "d"), lambda: t.swap(broken), lambda: t.append(broken), lambda: t.merge(broken, "k")):
        with pytest.raises(Exception, match="broken"):
            job()
    assert rows(t.read(), "k", "v") == [(1, "a")] and t.versions() == [1]


def test_the_second_of_two_writers_fails(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    t.replace(frame(spark, (1, "a", "2024-01-01")))
    stale = t.manifest()
    t.append(frame(spark, (2, "b", "2024-01-01")))
    with pytest.raises(versions.CommitConflict):
        t.commit(versions.Manifest(stale.version + 1, stale.schema, None, {}))
    assert t.read().count() == 2


def test_merge_reads_only_what_the_sketch_names(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    t.replace(days(spark), "d", "k")
    here = days(spark).filter("k in (0, 7919)").select("k", "d").collect()
    moved = frame(spark, (here[0].k, "new", "2024-03-01"), (500_000, "new", "2024-03-01"))
    before = folders(t)
    wanted = moved.select("k").distinct()
    named = t.candidates(wanted, ["k"])
    assert str(here[0].d) in named and len(named) <= 2
    # The plan that looks for the keys opens the files of the named partitions and no others.
    files = t.read(parts=named).inputFiles()
    assert files and all(any(f"d={p}/" in f for p in named) for f in files)
    t.merge(moved, "k")
    after = folders(t)
    changed = {p for p in after if after[p] != before.get(p)}
    assert changed == {str(here[0].d), "2024-03-01"}
    got = {r.k: (r.v, str(r.d)) for r in t.read().collect()}
    assert len(got) == 300 * 8 + 1 and got[here[0].k] == ("new", "2024-03-01")
    # The key that moved is found where it is now, by the sketch of the new folder.
    assert t.partitions_holding(wanted, ["k"]) == ["2024-03-01"]


def test_sketch_names_every_partition_that_holds_a_key(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    t.replace(days(spark, 400, 5), "d", "k", bits_per_key=8)
    for day in ("2024-01-01", "2024-01-04"):
        keys = days(spark, 400, 5).filter(F.col("d") == F.lit(day).cast("date")).select("k")
        assert day in t.candidates(keys, ["k"])
        assert t.partitions_holding(keys, ["k"]) == [day]
    assert t.partitions_holding(frame(spark, (None, "x", None)), ["k"]) == []
    few = spark.range(200_000, 200_050).select(F.col("id").alias("k"))
    assert t.partitions_holding(few, ["k"]) == []


def test_merge_strategies_and_rows_without_key_or_partition(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    t.replace(frame(spark, (1, "a", "2024-01-01"), (2, "b", None), (None, "n", "2024-01-01"), (3, "c", "2024-01-03")), "d", "k")
    before = folders(t)
    t.merge(frame(spark, (2, "B", "2024-01-02"), (4, "new", None)), "k")
    assert rows(t.read().filter("k is not null"), "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "new")]
    # A row without a partition rewrites that one partition, not the table.
    assert all(folders(t)[p] == before[p] for p in ("2024-01-01", "2024-01-03"))
    with pytest.raises(Exception, match="repeats a key"):
        t.merge(frame(spark, (1, "x", "2024-01-01"), (1, "y", "2024-01-02")), "k")
    t.merge(frame(spark, (1, "x", "2024-01-01"), (1, "y", "2024-01-02")), "k", "delete+insert")
    assert rows(t.read().filter("k = 1"), "v") == [("x",), ("y",)] and t.read().filter("k is null").count() == 1


RUN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from tidemark.session import build_session
from tidemark.sinks.versions import VersionedTable, incremental_version

spark = build_session("one of two", "local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {shared!r},
    "spark.sql.warehouse.dir": {shared!r} + "/" + sys.argv[1], "spark.sql.shuffle.partitions": "2"}})
rows = spark.range(int(sys.argv[2])).select("id", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 5 as int))").alias("ts"))
rows = rows.withColumn("day", F.to_date("ts")).withColumn("run", F.lit(sys.argv[1]))
rows = rows.withColumn("ts", F.when(F.col("id") >= 10, F.expr("ts + interval 9 days")).otherwise(F.col("ts")))
incremental_version(rows, {root!r}, "id", "ts", partition_by="day", partition_follows_ts=False)
t = VersionedTable(spark, {root!r})
print(sorted(map(tuple, t.read().groupBy("run").count().collect())))
"""


def test_state_outlives_the_session(spark, tmp_path):
    """Two sessions with catalogs of their own: the second goes on where the first one stopped."""
    repo = str(Path(__file__).resolve().parent.parent)
    script = RUN.format(repo=repo, shared=str(tmp_path / "shared"), root=str(tmp_path / "table"))
    out = [
        subprocess.run([sys.executable, "-c", script, *args], capture_output=True, text=True, timeout=120).stdout.strip()
        for args in (("first", "10"), ("second", "14"))
    ]
    assert out == ["[('first', 10)]", "[('first', 10), ('second', 4)]"]
    assert rows(VersionedTable(spark, str(tmp_path / "table")).read().groupBy("run").count()) == [("first", 10), ("second", 4)]


def test_only_the_last_partition_is_read_for_the_mark(spark, tmp_path):
    versions.incremental_version(days(spark), str(tmp_path), "k", "d", partition_by="d", partition_follows_ts=True)
    more = days(spark, 10, 10).withColumn("k", F.col("k") + 10**6)
    t = VersionedTable(spark, str(tmp_path))
    versions.incremental_version(more, str(tmp_path), "k", "d", partition_by="d", partition_follows_ts=True)
    assert t.read().filter("k >= 1000000").select("d").distinct().count() == 2


def test_a_version_is_looked_at_before_it_is_published(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    first = t.replace(frame(spark, (1, "a", "2024-01-01")), "d", publish=False)
    assert not t.exists() and t.read(first).count() == 1
    t.commit(first)
    pending = t.merge(frame(spark, (1, "b", "2024-01-02")), "k", publish=False)
    assert rows(t.read(pending), "v") == [("b",)] and rows(t.read(), "v") == [("a",)]
    t.commit(pending)
    assert rows(t.read(), "v") == [("b",)]


def look(spark, *data):
    return spark.createDataFrame(data, "k int, v string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))


def test_history_rewrites_no_settled_file(spark, tmp_path):
    from tidemark.operators.snapshot import snapshot
    from tidemark.sinks.history import OPEN, SETTLED, read_history, snapshot_version

    looks = [
        look(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-01"), (None, "n", "2024-01-01")),
        look(spark, (1, "A", "2024-01-02"), (2, "b", "2024-01-01"), (4, "d", "2024-01-02")),
        look(spark, (1, "AA", "2024-01-03"), (2, "B", "2024-01-03"), (4, "dd", "2024-01-02"), (None, "m", "2024-01-03")),
    ]
    table, want, before = VersionedTable(spark, str(tmp_path)), None, {}
    for source in looks:
        snapshot_version(source, str(tmp_path), "k", "at")
        want = snapshot(want, source, "k", "at")
        settled = {f: f.stat().st_mtime_ns for f in tmp_path.glob(f"data/*={SETTLED}/**/*.parquet")}
        assert before.items() <= settled.items()
        assert set(table.manifest().parts.get(SETTLED, ())) >= {f"{p.parent.parent.name}/{p.parent.name}" for p in before}
        assert len(table.manifest().parts[OPEN]) == 1
        before = settled
    got = read_history(spark, str(tmp_path))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.count() == 9 and read_history(spark, str(tmp_path), only_open=True).count() == 5 - 1
    wider = looks[2].withColumn("more", F.lit(1)).withColumn("at", F.expr("at + interval 5 days"))
    snapshot_version(wider, str(tmp_path), "k", "at")
    assert read_history(spark, str(tmp_path)).filter("more = 1").count() == 4


def test_history_by_check_of_columns(spark, tmp_path):
    from tidemark.sinks.history import read_history, snapshot_version

    root = str(tmp_path)
    for day, v in (("2024-01-01", "a"), ("2024-01-02", "a"), ("2024-01-03", "b")):
        snapshot_version(look(spark, (1, v, "2020-01-01")), root, "k", strategy="check", run_at=f"{day} 00:00:00")
    got = sorted((r.v, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in read_history(spark, root).collect())
    assert got == [("a", "2024-01-01 00:00:00", "2024-01-03 00:00:00"), ("b", "2024-01-03 00:00:00", "None")]


def test_compact_and_expire(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    t.replace(frame(spark, (0, "a", "2024-01-01"), (99, "z", None)), "d", "k")
    for k in range(1, 6):
        t.append(frame(spark, (k, "a", "2024-01-02")))
    assert len(t.manifest().parts["2024-01-02"]) == 5 and len(t.manifest().sketch["files"]) == 6
    assert t.compact(most=5).version == 6
    before = folders(t)
    t.compact(most=2)
    after = folders(t)
    assert len(after["2024-01-02"]) == 1 and all(after[p] == before[p] for p in ("2024-01-01", NO_VALUE))
    assert len(t.manifest().sketch["files"]) == 2
    wanted = frame(spark, (3, "", None), (99, "", None)).select("k")
    assert sorted(t.partitions_holding(wanted, ["k"])) == sorted(["2024-01-02", NO_VALUE])
    gone = t.expire(keep=1)
    assert len(gone) == 5 and t.versions() == [7] and rows(t.read(), "k") == [(k,) for k in (0, 1, 2, 3, 4, 5, 99)]
    assert t.expire(keep=3) == [] and len(list((tmp_path / "sketches").iterdir())) == 2
    t.merge(frame(spark, (3, "b", "2024-01-09")), "k")
    assert rows(t.read().filter("k = 3"), "v") == [("b",)] and t.read().count() == 7
    with pytest.raises(ValueError):
        t.expire(0)
    u = VersionedTable(spark, str(tmp_path / "plain"))
    u.replace(frame(spark, (0, "a", None)))
    for k in range(3):
        u.append(frame(spark, (k, "b", None)))
    u.compact(most=1)
    assert u.read().count() == 4 and len(u.expire(1)) == 4 and u.read().count() == 4
