"""Loads that can be repeated, archives without a suffix, errors in values, and streams with a reject table."""

from __future__ import annotations

import gzip
import os

import pytest

from tests.conftest import rows
from tidemark.plans import loads
from tidemark.plans.loads import Load, load_registry_tables, table_of
from tidemark.sinks.versions import VersionedTable
from tidemark.sources.files import read_dataset, read_dated
from tidemark.sources.registry import load_registry
from tidemark.streaming import landing

COLUMNS = [{"name": "id", "type": "integer"}, {"name": "name", "type": "varchar(5)"}, {"name": "at", "type": "timestamp"}]


def specs(tmp_path, **more):
    entry = {"columns": COLUMNS, "schema": "raw", "copy_options": ["TIMEFORMAT 'auto'"], **more}
    return load_registry({"datasets": {"users": entry, "extras": {**entry, "required": False}}}, str(tmp_path))


def put(tmp_path, name, text, date="2024-03-01", dataset="users"):
    folder = tmp_path / dataset / date
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return folder / name


HEAD = "id,name,at\n"


def test_a_repeated_load_skips_what_the_table_holds(spark, tmp_path):
    s, root = specs(tmp_path), str(tmp_path / "out")
    first = put(tmp_path, "a.csv", HEAD + "1,ann,2024-01-01\n2,bob,2024-01-02\n")
    assert load_registry_tables(spark, s, "2024-03-01", root) == [Load("users", "appended", 1)]
    table = table_of(spark, s["users"], root)
    assert table.root.endswith("/raw/users") and rows(table.read(), "id") == [(1,), (2,)]
    assert load_registry_tables(spark, s, "2024-03-01", root) == [Load("users", "skipped", 0)]
    put(tmp_path, "b.csv", HEAD + "3,cy,2024-01-03\n")
    put(tmp_path, "x.csv", HEAD + "9,x,\n", dataset="extras")
    assert load_registry_tables(spark, s, "2024-03-01", root) == [Load("users", "appended", 1), Load("extras", "appended", 1)]
    assert rows(table.read(), "id") == [(1,), (2,), (3,)]
    # Another date stands beside it; a file that has changed replaces its date only.
    put(tmp_path, "a.csv", HEAD + "7,gil,2024-01-07\n", "2024-03-02")
    load_registry_tables(spark, {"users": s["users"]}, "2024-03-02", root)
    first.write_text(HEAD + "1,ann,2024-01-01\n4,dee,2024-01-04\n5,eve,\n")
    os.utime(first, (1_700_000_000, 1_700_000_000))
    assert load_registry_tables(spark, {"users": s["users"]}, "2024-03-01", root) == [Load("users", "replaced", 2)]
    assert rows(table.read(), "id") == [(1,), (3,), (4,), (5,), (7,)]
    first.unlink()
    assert load_registry_tables(spark, {"users": s["users"]}, "2024-03-01", root) == [Load("users", "replaced", 1)]
    assert rows(table.read(), "id") == [(3,), (7,)]
    assert {"load_date", "_load_id", "_loaded_at"} < set(table.read().columns)


def test_a_load_that_was_cut_off_is_run_again(spark, tmp_path, monkeypatch):
    s, root = specs(tmp_path), str(tmp_path / "out")
    put(tmp_path, "a.csv", HEAD + "1,ann,\n")

    def fail(*_):
        raise RuntimeError("cut off")

    for method in ("replace", "append"):
        with monkeypatch.context() as m:
            m.setattr(VersionedTable, method, fail)
            with pytest.raises(RuntimeError):
                load_registry_tables(spark, s, "2024-03-01", root)
    # Recorded as a load, but no row of it is there: it counts for nothing.
    assert loads.ledger(spark, root).read().count() <= 1
    assert load_registry_tables(spark, s, "2024-03-01", root) == [Load("users", "appended", 1)]
    assert rows(table_of(spark, s["users"], root).read(), "id") == [(1,)]


def test_missing_folders(spark, tmp_path):
    s = specs(tmp_path)
    put(tmp_path, "x.csv", HEAD + "9,x,\n", dataset="extras")
    with pytest.raises(FileNotFoundError, match="users"):
        load_registry_tables(spark, s, "2024-03-01", str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError, match="no dataset"):
        load_registry_tables(spark, {"extras": s["extras"]}, "2024-03-09", str(tmp_path / "out"))


def test_gzip_by_declaration(spark, tmp_path):
    s = specs(tmp_path, compression="gzip")
    body = HEAD + "".join(f"{k},n{k % 9},2024-01-01\n" for k in range(40_000))
    put(tmp_path, "part-0", gzip.compress(body.encode()))
    put(tmp_path, "part-1.bin", gzip.compress((HEAD + '50000,"a,b",\n50001,é,').encode()))
    put(tmp_path, "part-2.gz", gzip.compress(HEAD.encode()))
    got = read_dated(spark, s, "2024-03-01")["users"]
    assert got.count() == 40_002 and rows(got.filter("id >= 50000"), "id", "name") == [(50000, "a,b"), (50001, "é")]
    j = load_registry({"datasets": {"users": {"columns": COLUMNS, "format": "json", "compression": "gzip"}}}, str(tmp_path))
    put(tmp_path, "lines", gzip.compress(b'{"id": 1, "name": "a"}\n{"id": 2}\n'), "2024-03-05")
    assert rows(read_dated(spark, j, "2024-03-05")["users"], "id", "name") == [(1, "a"), (2, None)]


@pytest.mark.parametrize("content", [b"no archive", gzip.compress(b"id\n" * 100_000)[:-20]])
def test_a_broken_archive_is_named(spark, tmp_path, content):
    s = specs(tmp_path, compression="gzip")
    put(tmp_path, "good", gzip.compress((HEAD + "1,a,\n").encode()))
    put(tmp_path, "broken", content)
    with pytest.raises(Exception, match="cannot unpack .*broken"):
        read_dated(spark, s, "2024-03-01")["users"].collect()


def test_maxerror_counts_values_and_lines(spark, tmp_path):
    put(tmp_path, "a.csv", HEAD + "1,ann,2024-01-01\nx,bob,\n3,too long,\n4,cy,no time\n5,d,2024-01-01,more\n")
    path = str(tmp_path / "users" / "2024-03-01")
    options = ["TIMEFORMAT 'auto'"]
    for most, fits in ((3, False), (4, True), (9, True)):
        spec = specs(tmp_path, copy_options=[*options, f"MAXERROR {most}"])["users"]
        if fits:
            assert rows(read_dataset(spark, spec, path), "id") == [(1,)]
        else:
            with pytest.raises(ValueError, match="more than 3 lines"):
                read_dataset(spark, spec, path)
    spec = specs(tmp_path, copy_options=[*options, "MAXERROR 3", "TRUNCATECOLUMNS"])["users"]
    assert rows(read_dataset(spark, spec, path), "id", "name") == [(1, "ann"), (3, "too l")]


def test_stream_keeps_rejects_and_survives_a_replay(spark, tmp_path):
    s, root = specs(tmp_path)["users"], str(tmp_path / "landed")
    put(tmp_path, "a.csv", HEAD + "1,ann,2024-01-01\nx,bob,\n5,d,2024-01-01,more\n")
    put(tmp_path, "b.csv", HEAD + "2,bea,\n", "2024-03-02")
    run = lambda: landing.stream_land_rejects(spark, s, root, str(tmp_path / "cp"), max_files=1).awaitTermination()
    run()
    good, bad = VersionedTable(spark, f"{root}/rows"), VersionedTable(spark, f"{root}/rejects")
    assert sorted((r.id, str(r.load_date)) for r in good.read().collect()) == [(1, "2024-03-01"), (2, "2024-03-02")]
    got = sorted((r.reason, r.line, os.path.basename(r.file)) for r in bad.read().collect())
    assert got == [("format", "5,d,2024-01-01,more", "a.csv"), ("types: id", '{"id":"x","name":"bob"}', "a.csv")]
    versions = good.versions(), bad.versions()
    # The last batch is replayed, as after a crash between its sinks and its commit.
    for f in (tmp_path / "cp" / "commits").iterdir():
        if f.name.lstrip(".").startswith("1"):
            f.unlink()
    run()
    assert (good.versions(), bad.versions()) == versions and good.read().count() == 2
    put(tmp_path, "c.csv", HEAD + "3,cy,\n", "2024-03-02")
    run()
    assert good.read().count() == 3 and good.manifest().marks == {str(tmp_path / "cp"): 2}


def test_stream_of_documents_and_paths(spark, tmp_path):
    put(tmp_path, "a.json", '{"a": {"id": 1}}\nno json\n{"a": {"id": "x"}}\n')
    entry = {"format": "json", "columns": [{"name": "payload", "type": "super"}]}
    s = load_registry({"datasets": {"users": entry}}, str(tmp_path))["users"]
    landing.stream_land_rejects(spark, s, str(tmp_path / "v"), str(tmp_path / "cp1")).awaitTermination()
    assert VersionedTable(spark, str(tmp_path / "v/rows")).read().count() == 2
    assert rows(VersionedTable(spark, str(tmp_path / "v/rejects")).read(), "reason", "line") == [("format", "no json")]
    entry = {"format": "json", "columns": [{"name": "id", "type": "integer"}], "jsonpaths": ["$.a.id"]}
    s = load_registry({"datasets": {"users": entry}}, str(tmp_path))["users"]
    landing.stream_land_rejects(spark, s, str(tmp_path / "p"), str(tmp_path / "cp2")).awaitTermination()
    assert rows(VersionedTable(spark, str(tmp_path / "p/rows")).read(), "id") == [(1,)]
    assert sorted(r.reason for r in VersionedTable(spark, str(tmp_path / "p/rejects")).read().collect()) == ["format", "types: id"]
