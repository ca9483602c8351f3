"""Steps that must leave little on disk while they run, and nothing after that they made for themselves."""

from __future__ import annotations

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import session
from tidemark.plans import industrial
from tidemark.plans.contracts import CONTRACTS
from workload import documents, inputs, plant

SCHEMA = "tag_id string, source_name string, ingested_at timestamp, data string"
LINE = """id l_orderkey, id % 7 l_partkey, id % 3 l_suppkey, 1 l_linenumber, 1D l_quantity, 1D l_extendedprice, 0.1D l_discount,
  CAST(id % 4 AS DOUBLE) / 50 l_tax, 'N' l_returnflag, 'F' l_linestatus, timestamp_ntz'2024-01-01' l_shipdate"""


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _measured(key, seconds, quality="Good", value=1):
    record = f'{{"MeasurementID": "MEAS-00000000000{key}", "TagID": "TAG-00001", "Timestamp": "2026-01-01 00:00:00", "Value": {value}, "QualityFlag": "{quality}"}}'
    return ("TAG-00001", "test", seconds, f'{{"tag": {{"TagID": "TAG-00001"}}, "measurements": [{record}, 7]}}')


def _raw(spark, *documents):
    return spark.createDataFrame(list(documents), SCHEMA.replace("timestamp", "long")).withColumn("ingested_at", F.timestamp_seconds("ingested_at"))


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """A shared folder of the test's own."""
    count = iter(range(1000))
    for module in (session, plant):
        monkeypatch.setattr(module, "shared_dir", lambda spark, label: f"{tmp_path}/shared/{label}-{next(count)}")
    return f"{tmp_path}/shared"


def _lines(spark, folder, tasks, n=1200):
    os.makedirs(folder)
    spark.range(0, n, 1, tasks).selectExpr(*re.split(r",\s+", LINE)).write.option("compression", "none").parquet(f"{folder}/lineitem.parquet")
    return folder


def test_staged_records_pass_no_shuffle_and_are_packed(spark, shared, monkeypatch):
    seen = []
    through = industrial.write_through
    monkeypatch.setattr(industrial, "write_through", lambda df, *a, **kw: seen.append(_plan(df)) or through(df, *a, **kw))
    raw = _raw(spark, *[_measured(i, i) for i in range(9)])
    records = industrial.stage_records(raw, ("tag", "measurement"))
    assert "Repartition" not in seen[0] and "Rebalance" not in seen[0]
    assert rows(records.groupBy("table").count()) == [("measurement", 18), ("tag", 9)]
    assert records.select("_row").distinct().count() == 27
    assert sorted(r[0] for r in records.select(F.unix_seconds("_ingested_at")).distinct().collect()) == list(range(9))
    files = glob.glob(f"{shared}/records-*/table=*/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_settings_that_spare_disk_end_with_the_last_block(spark):
    held = {key: spark.conf.get(key, None) for key in session.SPARING}
    with pytest.raises(ZeroDivisionError), session.sparing_disk(spark):
        with session.sparing_disk(spark):
            pass
        assert {key: spark.conf.get(key) for key in session.SPARING} == session.SPARING
        1 / 0
    assert {key: spark.conf.get(key, None) for key in session.SPARING} == held


def test_only_valid_rows_are_ranked_for_the_valid_ones(spark):
    raw = _raw(
        spark,
        _measured("A", 1), _measured("A", 2, value=2), _measured("A", 3, "Odd", value=3), _measured("B", 1, "Odd"),
        _measured("C", 1, value='"x"'), _measured("C", 2, value='"4"'),
    )
    records = industrial.stage_records(raw, ("measurement",))
    contract = CONTRACTS["measurement"]
    now, staged = industrial.clean_table(records, contract), industrial.clean_table(records, contract, stage=True)
    plan = _plan(now.valid.select(*contract.names))
    assert "Filter" in plan[plan.index("Window"):] and "reasons" not in plan[: plan.index("Window [")]
    assert rows(now.valid, "measurement_id", "value") == [("MEAS-00000000000A", 2.0), ("MEAS-00000000000C", 4.0)]
    for one in ("valid", "bad", "duplicates"):
        a, b = getattr(now, one), getattr(staged, one)
        assert a.columns == b.columns and rows(a, "_row") == rows(b, "_row")


def test_lines_are_dealt_out_only_if_their_files_do_not(spark, tmp_path):
    n = spark.sparkContext.defaultParallelism
    whole, dealt = _lines(spark, f"{tmp_path}/one", 1), _lines(spark, f"{tmp_path}/many", n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        one, many = (documents.tag_documents(spark, d) for d in (whole, dealt))
        assert inputs.table(spark, whole, "lineitem").rdd.getNumPartitions() > 1
        assert "RepartitionByExpression" in _plan(one) and "RepartitionByExpression" not in _plan(many)
        assert rows(one) == rows(many)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_go_as_their_tables_are_settled(spark, tmp_path, shared):
    d = _lines(spark, f"{tmp_path}/lines", 2, 100)
    wide = documents.tag_enrich(spark, d)
    assert glob.glob(f"{shared}/records-*") and not glob.glob(f"{shared}/records-*/table=*")
    # Every fourth line, sold without tax, has a broken document.
    assert wide.count() == 75 and wide.filter("site_name = 'site'").count() == 75
    report = {r.child: tuple(r)[2:] for r in documents.tag_fk_report(spark, d).collect()}
    assert report["measurement.tag_id"] == (0, 0) and not glob.glob(f"{shared}/records-*/table=*")


def test_a_batch_leaves_its_zones_only(spark, tmp_path, shared):
    d = _lines(spark, f"{tmp_path}/lines", 2, 100)
    counts = {(r.zone, r.table): r.n for r in plant.pipeline_zone_counts(spark, d).collect()}
    assert {table: counts["cleaned", table] for _, table in counts} == {
        table: sum(counts[z, table] for z in ("valid", "bad", "duplicates")) for _, table in counts
    }
    left = {f for f in glob.glob(f"{shared}/**/*.*", recursive=True) if os.path.isfile(f)}
    assert left and all("/batch-" in f or "/records-" in f and "/table=" not in f for f in left)
    cleaned = [f for f in left if "/cleaned/" in f]
    assert cleaned and all(f.endswith(".json.gz") for f in cleaned)


@pytest.mark.parametrize("few", (0, 100))
def test_copies_of_a_batch_are_found_by_their_numbers(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(industrial, "FEW_COPIES", few, raising=False)
    seen = []
    surplus = industrial.surplus
    monkeypatch.setattr(industrial, "surplus", lambda *a, **kw: seen.append(surplus(*a, **kw)) or seen[-1])
    raw = _raw(spark, *[_measured(i % 5, i) for i in range(20)])
    spent = []
    audit = industrial.run_batch(raw, f"{tmp_path}/out", "b", ("measurement",), spent=lambda: spent.append(os.listdir(f"{tmp_path}/out")))
    assert [tuple(r)[1:] for r in audit.collect()] == [("measurement", "complete", 40, 5, 20, 15)]
    assert spent == [["bad"]]
    assert ("LeftSemi" in _plan(seen[0])) == bool(few)
    copies = spark.read.parquet(f"{tmp_path}/out/duplicates/measurement")
    assert sorted(r[0] for r in copies.select(F.unix_seconds("_ingested_at")).collect()) == list(range(15))
