from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.sources.registry import load_registry
from tidemark.streaming.alerts import stream_alerts, window_alerts
from tidemark.streaming.dedup import stream_dedup
from tidemark.streaming.landing import stream_land
from tidemark.streaming.merge import stream_merge

SCHEMA = "id string, ts timestamp_ntz, series string, value double"
START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def batches(spark, folder, *parts):
    """One file per batch, in order."""
    for i, part in enumerate(parts):
        one = spark.createDataFrame(part, SCHEMA).coalesce(1)
        one.write.parquet(f"{folder}/b{i}")
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/b*")
    )


def run(stream, folder, mode="append"):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/check")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def test_alerts_on_batches_and_streams(spark, tmp_path):
    first = [("1", at(0), "errors", 3.0), ("2", at(4), "errors", 3.0), ("3", at(6), "errors", 5.0)]
    second = [("4", at(7), "errors", 1.0), ("5", at(8), "depth", 1.0), ("6", at(60), "errors", 1.0)]
    everything = spark.createDataFrame(first + second, SCHEMA)
    alerts = window_alerts(everything, "ts", "series", "value")
    assert rows(alerts) == [
        (at(0), at(5), "errors", 6.0),
        (at(5), at(10), "errors", 6.0),
    ]
    top = window_alerts(everything, "ts", "series", "value", agg="maximum", threshold=0)
    assert (at(5), at(10), "depth", 1.0) in rows(top) and top.count() == 4
    stream = batches(spark, tmp_path / "in", first, second)
    got = run(stream_alerts(stream, "ts", "series", "value"), str(tmp_path))
    assert sorted((r.series, r.observed) for r in got.collect()) == [("errors", 6.0)] * 2


def test_dedup_across_batches(spark, tmp_path):
    first = [("a", at(0), "s", 1.0), ("a", at(0), "s", 1.0), ("b", at(1), "s", 1.0)]
    second = [("a", at(2), "s", 2.0), ("c", at(3), "s", 1.0), ("c", at(3), "s", 1.0)]
    for presplit in (True, False):
        folder = tmp_path / str(presplit)
        stream = batches(spark, folder / "in", first, second)
        got = run(stream_dedup(stream, "id", "ts", presplit=presplit), str(folder))
        assert rows(got, "id", "value") == [("a", 1.0), ("b", 1.0), ("c", 1.0)]


def test_merge_over_batches(spark, tmp_path, table_name):
    name = table_name("merged")
    first = [("a", at(0), "s", 1.0), ("a", at(5), "s", 2.0), ("b", at(0), "s", 1.0)]
    second = [("a", at(9), "s", 3.0), ("c", at(-9999), "s", 4.0)]
    stream = batches(spark, tmp_path / "in", first, second).withColumn("day", F.to_date("ts"))
    for _ in range(2):
        stream_merge(
            stream, name, "id", [F.col("ts").desc()], f"{tmp_path}/check",
            partition_by="day", root=f"{tmp_path}/table",
        ).awaitTermination()
    assert rows(spark.table(name), "id", "value") == [("a", 3.0), ("b", 1.0), ("c", 4.0)]
    # The same batches once more, as after a lost checkpoint.
    stream_merge(
        stream, name, "id", [F.col("ts").desc()], f"{tmp_path}/other",
        partition_by="day", root=f"{tmp_path}/table",
    ).awaitTermination()
    assert rows(spark.table(name), "id", "value") == [("a", 3.0), ("b", 1.0), ("c", 4.0)]


def write(root, dataset, date, name, text):
    folder = root / "raw" / dataset / date
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_landing_takes_each_file_once(spark, tmp_path):
    spec = load_registry(
        {
            "defaults": {"root_prefix": "raw", "copy_options": ["EMPTYASNULL", "TIMEFORMAT 'auto'"]},
            "datasets": {
                "users": {
                    "columns": [
                        {"name": "user_id", "type": "varchar(64)"},
                        {"name": "created_at", "type": "timestamp"},
                    ]
                }
            },
        },
        base_uri=str(tmp_path),
    )["users"]
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"
    write(tmp_path, "users", "2024-01-01", "a.csv", "x,y\nu1,01/31/2024\n")
    stream_land(spark, spec, out, check).awaitTermination()
    write(tmp_path, "users", "2024-01-02", "b.csv", "x,y\nu2,oops\n")
    with pytest.raises(StreamingQueryException, match="cannot load oops"):
        stream_land(spark, spec, out, check).awaitTermination()
    stream_land(spark, spec, out, check, strict=False, max_files=1).awaitTermination()
    stream_land(spark, spec, out, check, strict=False).awaitTermination()
    got = spark.read.parquet(out).orderBy("user_id").collect()
    assert [tuple(r) for r in got] == [
        ("u1", dt.datetime(2024, 1, 31), dt.date(2024, 1, 1)),
        ("u2", None, dt.date(2024, 1, 2)),
    ]


def test_landing_json_forms(spark, tmp_path):
    line = json.dumps({"id": "1", "deep": {"at": "2024-01-31"}})
    forms = {
        "whole": {"columns": [{"name": "payload", "type": "super"}]},
        "named": {"columns": [{"name": "id", "type": "integer"}]},
        "paths": {"columns": [{"name": "day", "type": "date"}], "jsonpaths": ["$.deep.at"]},
    }
    specs = load_registry(
        {
            "defaults": {"root_prefix": "raw", "format": "json"},
            "datasets": forms,
        },
        base_uri=str(tmp_path),
    )
    for name, spec in specs.items():
        write(tmp_path, name, "2024-01-01", "a.json", line + "\n")
        stream_land(spark, spec, f"{tmp_path}/{name}", f"{tmp_path}/c-{name}").awaitTermination()

    def first(name):
        return spark.read.parquet(f"{tmp_path}/{name}")

    assert first("named").first().id == 1
    assert first("paths").first().day == dt.date(2024, 1, 31)
    assert first("whole").selectExpr("variant_get(payload, '$.deep.at', 'string') x").first().x == "2024-01-31"
