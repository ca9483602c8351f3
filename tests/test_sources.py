from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.sources import files
from tidemark.sources.registry import DatasetSpec, load_registry, schema_from_registry

REGISTRY = """
defaults:
  schema: raw_zone
  s3_bucket: bucket
  root_prefix: raw
  format: csv
  header: true
  copy_options: [TRUNCATECOLUMNS, BLANKSASNULL, EMPTYASNULL, "TIMEFORMAT 'auto'"]
datasets:
  users:
    required: false
    columns:
      - {name: user_id, type: varchar(64)}
      - {name: country, type: char(2)}
      - {name: created_at, type: timestamp}
  events:
    format: JSON
    table: raw_events
    jsonpath: [$.id]
    copy_options: [COMPUPDATE]
    columns: [{name: payload, type: super}]
  bare:
"""
DATE = "2024-03-01"


def write(root, dataset, name, content, date=DATE):
    folder = root / "raw" / dataset / date
    folder.mkdir(parents=True, exist_ok=True)
    data = content.encode()
    (folder / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)


def registry(root, **dataset):
    columns = [
        {"name": "user_id", "type": "varchar(4)"},
        {"name": "country", "type": "char(2)"},
        {"name": "created_at", "type": "timestamp"},
        {"name": "score", "type": "decimal(10,2)"},
    ]
    options = ["TRUNCATECOLUMNS", "BLANKSASNULL", "EMPTYASNULL", "TIMEFORMAT 'auto'"]
    return load_registry(
        {
            "defaults": {"root_prefix": "raw", "copy_options": options},
            "datasets": {"users": {"columns": columns, **dataset}},
        },
        base_uri=str(root),
    )


def test_registry_merges_defaults(spark, tmp_path):
    path = tmp_path / "registry.yml"
    path.write_text(REGISTRY)
    for specs in (load_registry(str(path)), load_registry(str(path), spark=spark)):
        users, events, bare = specs["users"], specs["events"], specs["bare"]
        assert (users.table, users.format, users.required) == ("users", "csv", False)
        assert users.path == "s3a://bucket/raw/users"
        assert users.qualified_table == "raw_zone.users"
        assert (events.table, events.format, events.required) == ("raw_events", "json", True)
        assert events.jsonpaths == ("$.id",)
        assert events.load_options[0] == "TRUNCATECOLUMNS" and events.load_options[-1] == "COMPUPDATE"
        assert bare.schema is None


def test_registry_errors(tmp_path):
    with pytest.raises(ValueError, match="datasets"):
        load_registry({"defaults": {}})
    with pytest.raises(ValueError, match="avro"):
        load_registry({"datasets": {"a": {"format": "avro"}}})
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"datasets": {"a": {"format": None}}}))
    assert load_registry(str(path))["a"].format == "csv"


def test_types():
    declared = {
        "varchar(64)": T.StringType(),
        "char(2)": T.StringType(),
        "timestamp": T.TimestampNTZType(),
        "super": T.VariantType(),
        "integer": T.IntegerType(),
        "decimal(10,2)": T.DecimalType(10, 2),
        "double precision": T.DoubleType(),
        "DATE": T.DateType(),
    }
    schema = schema_from_registry([(f"c{i}", t) for i, t in enumerate(declared)])
    assert [f.dataType for f in schema] == list(declared.values())
    assert schema["c0"].metadata == {"length": 64}
    with pytest.raises(ValueError, match="blob"):
        schema_from_registry([("c", "blob")])


def test_csv_binds_by_position_and_applies_options(spark, tmp_path):
    text = "a|b|c|d\nu123456|DEU|31-Jan-2024|1.5\n u|  |20240131100000|\n"
    write(tmp_path, "users", "part.csv.gz", text)
    specs = registry(tmp_path, delimiter="|", compression="gzip")
    got = files.read_dated(spark, specs, DATE)["users"]
    assert got.columns == ["user_id", "country", "created_at", "score", "load_date"]
    day = dt.date(2024, 3, 1)
    assert rows(got) == [
        (" u", None, dt.datetime(2024, 1, 31, 10), None, day),
        ("u123", "DE", dt.datetime(2024, 1, 31), got.first().score, day),
    ]


def test_csv_without_header(spark, tmp_path):
    write(tmp_path, "users", "part.csv", "u1,DE,2024-01-01,1\nu2,FR,2024-01-02,2\n")
    assert files.read_dated(spark, registry(tmp_path, header=False), DATE)["users"].count() == 2


def test_strict_and_lenient_loads(spark, tmp_path):
    write(tmp_path, "users", "part.csv", "h,h,h,h\nu1,DE,someday,1\n")
    specs = registry(tmp_path)
    with pytest.raises(PySparkException, match="users.created_at: cannot load someday"):
        files.read_dated(spark, specs, DATE)["users"].collect()
    lenient = files.read_dated(spark, specs, DATE, strict=False)["users"]
    assert [r.created_at for r in lenient.collect()] == [None]


@pytest.mark.parametrize(
    "dataset,content",
    [
        ({}, "h,h,h,h\nu1,DE,2024-01-01\n"),
        ({}, "h,h,h,h\nu1,DE,2024-01-01,1,more\n"),
        ({"format": "json"}, '{"user_id": "u1"}\n{"user_id": \n'),
        ({"format": "json", "jsonpaths": ["$.a", "$.b", "$.c", "$.d"]}, '{"a": "u1"}\n{"a"\n'),
    ],
)
def test_lines_that_do_not_fit_stop_a_strict_load(spark, tmp_path, dataset, content):
    write(tmp_path, "users", "part.txt", content)
    specs = registry(tmp_path, **dataset)
    with pytest.raises(PySparkException, match="users: cannot read the line"):
        files.read_dated(spark, specs, DATE)["users"].collect()
    with pytest.raises(PySparkException, match="users: cannot read the line"):
        files.read_dated(spark, specs, DATE)["users"].select("country").count()
    kept = files.read_dated(spark, specs, DATE, strict=False)["users"].count()
    assert files.rejected_lines(spark, specs["users"], f"{tmp_path}/raw/users/{DATE}").count() == 1
    some = registry(tmp_path, **dataset, copy_options=["MAXERROR 1"])
    assert files.read_dated(spark, some, DATE)["users"].count() == kept
    with pytest.raises(ValueError, match="more than 0 lines"):
        files.read_dated(spark, registry(tmp_path, **dataset, copy_options=["MAXERROR AS 0"]), DATE)


def test_declared_gzip_must_be_an_archive(spark, tmp_path):
    """Files without the suffix are unpacked by the declaration; one that is no archive stops the load by name."""
    write(tmp_path, "users", "part.csv", "h,h,h,h\nu1,DE,2024-01-01,1\n")
    with pytest.raises(Exception, match="cannot unpack .*part.csv"):
        files.read_dated(spark, registry(tmp_path, compression="gzip"), DATE)


def test_options_must_be_known(tmp_path):
    for option in ("NOSUCHOPTION", "FILLRECORD"):
        with pytest.raises(ValueError, match=option):
            registry(tmp_path, copy_options=[option])
    with pytest.raises(ValueError, match="bzip9"):
        registry(tmp_path, compression="bzip9")


def test_text_options(spark, tmp_path):
    folder = tmp_path / "raw" / "users" / DATE
    folder.mkdir(parents=True)
    (folder / "a.csv").write_bytes(b"h,h,h,h\na\xffb,NUL,2024-01-01,1\n")
    specs = registry(tmp_path, copy_options=["ACCEPTINVCHARS AS '^'", "NULL AS 'NUL'"])
    got = files.read_dated(spark, specs, DATE)["users"].first()
    assert (got.user_id, got.country) == ("a^b", None)


def test_json_by_name_and_by_path(spark, tmp_path):
    lines = [
        {"score": "12.5", "user_id": "u1", "created_at": "2024-01-01T00:00:00", "other": 1},
        {"score": 7, "user_id": "u2", "country": "FR", "nested": {"a": [{"b": "x"}]}},
    ]
    write(tmp_path, "users", "part.json", "\n".join(map(json.dumps, lines)))
    got = files.read_dated(spark, registry(tmp_path, format="json"), DATE)["users"]
    assert sorted((r.user_id, r.country, float(r.score)) for r in got.collect()) == [
        ("u1", None, 12.5),
        ("u2", "FR", 7.0),
    ]
    paths = ["$.user_id", "$['nested']['a'][0].b", "$.created_at", "$.score"]
    got = files.read_dated(spark, registry(tmp_path, format="json", jsonpaths=paths), DATE)
    assert sorted((r.user_id, r.country) for r in got["users"].collect()) == [
        ("u1", None),
        ("u2", "x"),
    ]
    document = tmp_path / "paths.json"
    document.write_text(json.dumps({"jsonpaths": paths}))
    specs = registry(tmp_path, format="json", jsonpaths=str(document))
    assert files.read_dated(spark, specs, DATE)["users"].count() == 2
    with pytest.raises(ValueError, match="1 paths for 4 columns"):
        files.read_dated(spark, registry(tmp_path, format="json", jsonpaths=["$.a"]), DATE)


def test_variant_lines(spark, tmp_path):
    write(tmp_path, "users", "p.json", '{"id": 1}\n{"payload": {"id": 2}}\nnot json\n')
    columns = [{"name": "payload", "type": "super"}]
    specs = registry(tmp_path, format="json", columns=columns)
    got = files.read_dated(spark, specs, DATE, strict=False)["users"]
    ids = got.selectExpr("try_variant_get(payload, '$.id', 'int') id").collect()
    assert sorted(r.id for r in ids) == [1, 2]
    with pytest.raises(PySparkException, match="cannot read the line not json"):
        files.read_dated(spark, specs, DATE)["users"].collect()
    path = f"{tmp_path}/raw/users/{DATE}"
    assert [r.value for r in files.bad_lines(spark, path).collect()] == ["not json"]


def test_missing_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="required dataset 'users'"):
        files.read_dated(spark, registry(tmp_path), DATE)
    with pytest.raises(FileNotFoundError, match="no dataset"):
        files.read_dated(spark, registry(tmp_path, required=False), DATE)
    (tmp_path / "raw" / "users" / DATE).mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        files.read_dated(spark, registry(tmp_path), DATE)


def test_load_date():
    assert files.resolve_load_date("a", {"load_date": "b"}, "c") == "a"
    assert files.resolve_load_date(None, {"load_date": "b"}, "c") == "b"
    assert files.resolve_load_date(None, {}, dt.date(2024, 1, 2)) == "2024-01-02"
    with pytest.raises(ValueError):
        files.resolve_load_date()


def test_parquet_pushes_filters_and_prunes(spark, tmp_path):
    path = f"{tmp_path}/raw/users/{DATE}"
    spark.range(10).selectExpr("id", "id * 2 twice", "'x' other").write.parquet(path)
    spec = DatasetSpec("users", "users", f"{tmp_path}/raw/users", format="parquet")
    got = files.read_dated(spark, {"users": spec}, DATE)["users"].filter("id > 7").select("twice")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,7)" in plan and "other" not in plan
    assert rows(got) == [(16,), (18,)]
