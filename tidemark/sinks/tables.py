"""Catalog tables on plain Parquet.

A table is never overwritten in place. New content goes to a new folder and
the table, or one of its date partitions, is then pointed at it. A job that
fails or is run again leaves the old content readable until that moment.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import delete_insert, merge_upsert, newer_than_max
from tidemark.session import write_through

# Fixed value: what a partition without a value is called.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

_PLAIN_VALUE = re.compile(r"^[A-Za-z0-9_.-]+$")
_PARTITIONS_AT_ONCE = 500

_MERGES = {"merge": merge_upsert, "delete+insert": delete_insert}


def with_loaded_at(df: DataFrame) -> DataFrame:
    return df.withColumn("_loaded_at", F.localtimestamp())


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def table_root(spark: SparkSession, name: str) -> str:
    """The default folder of a table, below the warehouse."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"


def require_lasting_catalog(spark: SparkSession) -> None:
    """On a cluster, refuse a catalog that is gone with the session.

    The next run would not find the table, and build it anew from its load alone. Use a
    Hive catalog there, or tables of ``sinks.versions``, whose state lies in their files.
    """
    local = spark.conf.get("spark.master", "").startswith("local")
    if not local and spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
        raise ValueError("merges need a catalog that outlives the session: see sinks.versions")


def create_if_absent(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: str | None = None,
    root: str | None = None,
) -> None:
    """Create the schema and the table unless they exist."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    partitioned = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    location = _new_folder(root or table_root(spark, name))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} "
        f"LOCATION '{location}'"
    )


def append_table(
    df: DataFrame,
    name: str,
    partition_by: str | None = None,
    root: str | None = None,
    mode: str = "append",
) -> None:
    """Create the table if need be, then add the rows.

    ``append`` adds them again when a load is repeated. ``replace_date``
    replaces the partitions that the rows belong to instead.
    """
    spark = df.sparkSession
    create_if_absent(spark, name, df.schema, partition_by, root)
    _add_columns(spark, name, df)
    if mode == "append":
        rows = _by_position(df, name)
        if partition_by:
            # Gathered by partition, or every task would add a file to every partition.
            rows = rows.hint("rebalance", partition_by)
        rows.write.mode("append").insertInto(name)
    elif mode == "replace_date":
        if partition_by is None:
            raise ValueError("replace_date needs a partitioned table")
        _swap_partitions(df, name, partition_by, root)
    else:
        raise ValueError(f"unknown mode {mode!r}")


def build_table(
    df: DataFrame, name: str, partition_by: str | None = None, root: str | None = None
) -> None:
    """Rebuild a table from scratch: write the new content, then point the table at it."""
    spark = df.sparkSession
    folder = _new_folder(root or table_root(spark, name))
    _write(df, folder, partition_by)
    columns = [(f.name, f.dataType) for f in df.schema]
    same = spark.catalog.tableExists(name) and columns == [
        (f.name, f.dataType) for f in spark.table(name).schema
    ]
    if same and partition_by is None:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"REFRESH TABLE {name}")
        return
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    # The table is external: dropping the entry leaves its files alone.
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    partitioned = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({declared}) USING parquet {partitioned} LOCATION '{folder}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def reload_table(df: DataFrame, name: str, root: str | None = None) -> None:
    """Empty a table and load it anew, without a moment in which it is empty.

    The table keeps its columns: rows bind to them by name, the load time is added.
    """
    spark = df.sparkSession
    if "_loaded_at" not in df.columns:
        df = with_loaded_at(df)
    if spark.catalog.tableExists(name):
        df = df.select(*spark.table(name).columns)
    build_table(df, name, root=root)


def merge_table(
    source: DataFrame,
    name: str,
    key: str | Sequence[str],
    partition_by: str | None = None,
    strategy: str = "merge",
    root: str | None = None,
) -> None:
    """Merge the source into a table by key.

    Of a partitioned table only partitions are rewritten that the source has
    rows for, or that hold a row with a key of the source. New columns of the
    source are added to the table.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(name):
        build_table(source, name, partition_by, root)
        return
    merge = _MERGES[strategy]
    # Read several times below: worked out once, and safe from changes of the target.
    source = write_through(source, "merge-source")
    _add_columns(spark, name, source)
    target = spark.table(name)
    if partition_by is None:
        build_table(merge(target, source, key).select(*target.columns), name, root=root)
        return
    keys = [key] if isinstance(key, str) else list(key)
    wanted = source.select(*keys).dropna().distinct()
    held = target.select(*keys, partition_by).join(wanted, keys, "left_semi").select(partition_by)
    # As many values as there are days in the load.
    touched = [
        r[0] for r in source.select(partition_by).distinct().union(held.distinct()).distinct().collect()
    ]
    part = target.filter(F.col(partition_by).isin([v for v in touched if v is not None]))
    if None in touched:
        # Rows without a value have a partition of their own, like any other.
        part = part.unionByName(target.filter(F.col(partition_by).isNull()))
    merged = merge(part, source, key).select(*target.columns)
    _swap_partitions(merged, name, partition_by, root, touched)


def incremental_table(
    source: DataFrame,
    name: str,
    key: str | Sequence[str],
    ts: str,
    strategy: str = "merge",
    partition_by: str | None = None,
    lookback: str | None = None,
    root: str | None = None,
    partition_follows_ts: bool = False,
    any_catalog: bool = False,
) -> None:
    """First run: build the table. Later: merge the rows newer than its newest.

    ``partition_follows_ts`` says that the partition column grows with ``ts``,
    as its date does. The newest row is then looked for in the last partition
    only, and not in the whole table.

    On a cluster a catalog that is gone with the session is refused, unless
    ``any_catalog`` says that all runs are in this session.
    """
    spark = source.sparkSession
    if not any_catalog:
        require_lasting_catalog(spark)
    existing = spark.table(name) if spark.catalog.tableExists(name) else None
    if existing is not None and partition_by and partition_follows_ts:
        existing = _last_partition(existing, name, partition_by)
    fresh = newer_than_max(source, existing, ts, lookback=lookback)
    merge_table(fresh, name, key, partition_by, strategy, root)


def _last_partition(df: DataFrame, name: str, partition_by: str) -> DataFrame:
    # From the catalog: one row per partition, and no files are opened.
    value = F.regexp_extract("partition", "=(.*)$", 1)
    kind = df.schema[partition_by].dataType
    last = (
        df.sparkSession.sql(f"SHOW PARTITIONS {name}")
        .select(F.when(value != _NO_VALUE, value).cast(kind).alias("value"))
        .agg(F.max("value"))
        .head()[0]
    )
    return df if last is None else df.filter(F.col(partition_by) == F.lit(last))


def _new_folder(root: str) -> str:
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"


def _write(df: DataFrame, folder: str, partition_by: str | None) -> None:
    if partition_by is None:
        df.write.parquet(folder)
        return
    # Gathered by partition, in parts of even size: without this every task
    # would write a file to every partition.
    df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(folder)


def _add_columns(spark: SparkSession, name: str, df: DataFrame) -> None:
    have = set(spark.table(name).columns)
    new = [f for f in df.schema if f.name not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def _by_position(df: DataFrame, name: str) -> DataFrame:
    have = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in df.sparkSession.table(name).schema
        ]
    )


def _swap_partitions(
    df: DataFrame,
    name: str,
    partition_by: str,
    root: str | None,
    touched: Sequence | None = None,
) -> None:
    """Write the rows below a new folder, then point their partitions at it.

    A touched partition that got no rows is dropped. Each partition changes at
    one moment; after a failure in between, running the load again completes it.
    """
    spark = df.sparkSession
    folder = _new_folder(root or table_root(spark, name))
    _write(df, folder, partition_by)
    written = spark.read.schema(df.schema).parquet(folder).select(partition_by).distinct()
    now = [_NO_VALUE if r[0] is None else str(r[0]) for r in written.collect()]
    if not all(_PLAIN_VALUE.match(v) for v in now):
        raise ValueError(f"{name} has values of {partition_by} that cannot name a partition")
    spec = lambda v: f"PARTITION (`{partition_by}` = {'NULL' if v == _NO_VALUE else repr(v)})"
    there = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    # New partitions are added many at a time; changing one is a step of its own.
    new = [v for v in now if v not in there]
    for i in range(0, len(new), _PARTITIONS_AT_ONCE):
        added = " ".join(
            f"{spec(v)} LOCATION '{folder}/{partition_by}={v}'"
            for v in new[i : i + _PARTITIONS_AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for v in now:
        if v in there:
            spark.sql(f"ALTER TABLE {name} {spec(v)} SET LOCATION '{folder}/{partition_by}={v}'")
    for v in (_NO_VALUE if v is None else str(v) for v in touched or ()):
        if v in there and v not in now:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec(v)}")
    spark.sql(f"REFRESH TABLE {name}")
