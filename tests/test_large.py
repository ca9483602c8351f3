"""Steps whose cost must grow no faster than their input."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from tidemark.plans import industrial
from tidemark.sinks import versions, zones
from tidemark.sources import documents
from workload import inputs, layers, plant


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _document(i):
    data = f'{{"tag": {{"TagID": "TAG-0000{i}"}}, "measurements": [{{"MeasurementID": "M{i}"}}, 7]}}'
    return (f"TAG-0000{i}", "test", None, data)


SCHEMA = "tag_id string, source_name string, ingested_at timestamp, data string"


def test_documents_looked_at_for_faults_are_parsed_once(spark):
    parsed = documents.parse_tag_document(spark.createDataFrame([_document(1)], SCHEMA))
    assert _plan(documents.malformed(parsed)).lower().count("parsejson(") == 1


def test_every_fault_of_a_document_is_named(spark):
    texts = {
        '{"tag": {}, "alarms": []}': None, '{"tag": null, "alarms": null}': None, "{}": None,
        '{"tag": [1], "alarms": {"a": 1}, "events": "[1]", "billing": 7, "location": "x"}':
            ["malformed:alarms", "malformed:billing", "malformed:events", "malformed:location", "malformed:tag"],
        "[1]": ["malformed:data"], "{": ["malformed:data"],
    }
    raw = spark.createDataFrame([("t", "s", None, x) for x in [*texts, None]], SCHEMA)
    bad = documents.malformed(documents.parse_tag_document(raw))
    assert bad.columns == [*raw.columns, "reasons"]
    found = {r.data: r.reasons for r in bad.collect()}
    assert found == {**{k: v for k, v in texts.items() if v}, None: ["malformed:data"]}


def test_files_of_staged_records_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(industrial, "ROWS_PER_FILE", 10)
    raw = spark.createDataFrame([_document(i) for i in range(9)] * 10, SCHEMA)
    records = industrial.stage_records(raw)
    counts = records.groupBy("table", F.input_file_name().alias("file")).count().collect()
    assert max(r["count"] for r in counts) <= 10
    assert sum(r["count"] for r in counts if r.table == "measurement") == 180


def test_raw_zone_is_packed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zones, "ROWS_PER_FILE", 10, raising=False)
    raw = spark.createDataFrame([_document(i) for i in range(25)], SCHEMA).coalesce(1)
    zones.write_zone(raw, "raw", str(tmp_path / "raw"))
    assert len(glob.glob(str(tmp_path / "raw/*.json.snappy"))) == 3
    assert spark.read.schema(SCHEMA).json(str(tmp_path / "raw")).exceptAll(raw).isEmpty()


def test_keys_of_a_sketch_meet_before_their_bitmaps_are_made(spark):
    rows = spark.range(5000).select("id", F.lit("p").alias("part"), F.lit("r").alias("run"))
    maps = versions._bitmaps(rows, ["id"], 5, 8)
    # The innermost step is the exchange of one row for each key; nothing is aggregated below it.
    plan = _plan(maps)
    assert "Aggregate" not in plan[plan.index("RebalancePartitions"):] and "Aggregate" in plan
    block, bits = versions._places(["id"], 5, 8)
    wanted = rows.select(block.alias("block"), F.explode(F.array(*bits)).alias("bit")).distinct().groupBy("block").count()
    held = maps.select("block", F.bitmap_count("bitmap").alias("count"))
    assert held.exceptAll(wanted).isEmpty() and held.count() == wanted.count()


def test_stand_ins_are_dealt_out_before_they_are_made_into_text(spark, tmp_path):
    spark.sql(
        "SELECT 1L event_id, timestamp_ntz'2024-01-01' ts, 1L user_id, 'view' event_type, 1D value, '{}' props"
    ).write.parquet(str(tmp_path / "events.parquet"))
    spark.sql(
        """SELECT 1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 1D l_quantity, 1D l_extendedprice, 0D l_discount,
           0D l_tax, 'N' l_returnflag, 'O' l_linestatus, timestamp_ntz'2024-01-01' l_shipdate"""
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    for made in (inputs.raw_events(spark, str(tmp_path)), plant.plant_documents(spark, str(tmp_path))):
        plan = _plan(made)
        assert "StructsToJson" not in plan[plan.index("RepartitionByExpression"):] and "StructsToJson" in plan


def test_events_of_the_layers_are_made_once(spark, tmp_path):
    for name in ("nation", "customer", "part", "orders"):
        columns = {
            "nation": "0L n_nationkey, 'X' n_name",
            "customer": "1L c_custkey, 'a' c_name, 0L c_nationkey, 'B' c_mktsegment",
            "part": "1L p_partkey, 'a' p_name, 'b' p_type, 'c' p_brand, 1 p_size",
            "orders": "1L o_orderkey, 1L o_custkey, 1D o_totalprice, timestamp_ntz'1998-01-01' o_orderdate, '5-LOW' o_orderpriority",
        }[name]
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.sql(
        """SELECT id event_id, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) ts, id user_id, 'view' event_type,
           1D value, '{"k": 1}' props FROM range(31)"""
    ).write.parquet(str(tmp_path / "events.parquet"))
    first, second = layers._loads(spark, str(tmp_path))
    assert [load["events"].count() for load in (first, second)] == [15, 16]
    assert "StructsToJson" not in _plan(first["events"]) + _plan(second["events"])
