"""Registry datasets into tables: which files a table holds is on record, so a load can be repeated."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import in_parallel
from tidemark.sinks.tables import with_loaded_at
from tidemark.sinks.versions import VersionedTable
from tidemark.sources.files import has_files, read_dataset
from tidemark.sources.registry import DatasetSpec

#: Every row of a table has the id of the load that brought it.
LOAD_ID = "_load_id"
LEDGER = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("load_date", T.DateType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Load:
    """What a load did to one dataset: ``appended``, ``replaced``, or ``skipped`` with nothing new."""

    dataset: str
    action: str
    files: int


def table_of(spark: SparkSession, spec: DatasetSpec, root: str) -> VersionedTable:
    below = f"{spec.schema_name}/{spec.table}" if spec.schema_name else spec.table
    return VersionedTable(spark, f"{root.rstrip('/')}/{below}")


def ledger(spark: SparkSession, root: str) -> VersionedTable:
    """The files of all loads. Those of a load count once the load's rows are in the table."""
    table = VersionedTable(spark, f"{root.rstrip('/')}/_ledger")
    table.create(LEDGER, "dataset")
    return table


def load_registry_tables(
    spark: SparkSession, specs: Mapping[str, DatasetSpec], load_date: str, root: str, strict: bool = True
) -> list[Load]:
    """Load every dataset's folder of one date into its table, which is made if absent.

    Files that the table holds already are skipped. New ones beside them are appended. If
    a file has another size or time than when it was loaded, or is gone, the whole date is
    loaded again in place of what was there. So a load that is run twice, or was cut off,
    gives the table that one run gives.

    A required dataset without files is an error, an optional one is left out; nothing at
    all is an error. Loads of one root run one after the other.
    """
    paths = {name: f"{spec.path.rstrip('/')}/{load_date}/" for name, spec in specs.items()}
    there = dict(zip(specs, in_parallel(lambda n: has_files(spark, paths[n]), specs)))
    for name, spec in specs.items():
        if spec.required and not there[name]:
            raise FileNotFoundError(f"required dataset {name!r} has no files under {paths[name]}")
    if not any(there.values()):
        raise FileNotFoundError(f"no dataset has files for {load_date}")
    files = {n: _files(spark, n, paths[n], load_date) for n in specs if there[n]}
    book = ledger(spark, root)
    known = book.read().filter(F.col("load_date") == F.lit(load_date).cast("date"))
    plans = {}
    for name, found in files.items():
        table = table_of(spark, specs[name], root)
        held = _held(known.filter(F.col("dataset") == name), table, load_date)
        # One row for each file of one dated folder.
        rows = found.join(held, ["path"], "full_outer").select("path", "size", "modified", "old_size", "old_modified").collect()
        changed = [r for r in rows if r.old_size is not None and (r.size, r.modified) != (r.old_size, r.old_modified)]
        new = [r.path for r in rows if r.size is not None and (changed or r.old_size is None)]
        plans[name] = (table, "replaced" if changed else "appended" if new else "skipped", new, uuid.uuid4().hex)
    entries = [
        files[n].filter(F.col("path").isin(new)).withColumn(LOAD_ID, F.lit(load_id))
        for n, (_, _, new, load_id) in plans.items() if new
    ]
    # Before the rows: an entry without rows of its load in the table counts for nothing.
    for i, df in enumerate(entries):
        entries[i] = df.select("dataset", "load_date", F.col(LOAD_ID).alias("load_id"), "path", "size", "modified")
    if entries:
        every = entries[0]
        for df in entries[1:]:
            every = every.unionByName(df)
        book.append(every)

    def load(name: str) -> Load:
        table, action, new, load_id = plans[name]
        if action == "skipped":
            return Load(name, action, 0)
        if not new:
            table.swap(table.read().limit(0), [load_date])
            return Load(name, action, 0)
        rows = with_loaded_at(read_dataset(spark, specs[name], new, strict)).withColumns(
            {"load_date": F.lit(load_date).cast("date"), LOAD_ID: F.lit(load_id)}
        )
        if not table.exists():
            table.replace(rows, "load_date")
        elif action == "replaced":
            table.swap(rows, [load_date])
        else:
            table.append(rows)
        return Load(name, action, len(new))

    return in_parallel(load, plans)


def _files(spark: SparkSession, name: str, path: str, load_date: str) -> DataFrame:
    # Names, sizes and times only: the content is pruned from the scan.
    return spark.read.format("binaryFile").load(path).select(
        F.lit(name).alias("dataset"),
        F.lit(load_date).cast("date").alias("load_date"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def _held(known: DataFrame, table: VersionedTable, load_date: str) -> DataFrame:
    """The recorded files of one dataset and date whose load has rows in the table."""
    old = known.select("path", F.col("size").alias("old_size"), F.col("modified").alias("old_modified"), "load_id")
    if not table.exists():
        return old.limit(0).drop("load_id")
    # One column with one value a load: it costs next to nothing to read.
    loads = table.read(parts=[load_date]).select(F.col(LOAD_ID).alias("load_id")).distinct()
    return old.join(loads, "load_id", "left_semi").drop("load_id")
