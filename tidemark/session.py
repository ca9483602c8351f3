"""Session settings, and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache
from threading import Lock
from typing import Any
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: For writes that make several times their input, see ``sparing_disk``. Times take 8 bytes, not 12. A task
#: has a file open for each table it writes to, where it would sort its rows by table, in a spill as large.
SPARING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}
_sparing: dict[str, str | None] = {}
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_blocks, _lock = 0, Lock()


def build_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are written for.

    On a cluster leave ``master`` out and let spark-submit decide. Executor
    memory, shuffle partitions and the checkpoint folder belong to the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_fallback() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the cluster's ``spark.checkpoint.dir``.

    A local temporary folder is used only when the setting is missing and the
    session runs in local mode; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_fallback()
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def write_through(
    df: DataFrame, label: str, partition_by: tuple[str, ...] = (), most_rows: int | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows restarts from files, so a lost executor
    costs one task and not the whole history of the plan.

    ``most_rows`` starts a new file after so many rows. Rows that take far more work than
    room are then read back by many tasks: Spark deals files out by their bytes.
    """
    path = shared_dir(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if most_rows:
        writer = writer.option("maxRecordsPerFile", most_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _blocks:
        # Numbers and text by their differences. Not every reader knows these pages: for own files only.
        writer = writer.option("parquet.writer.version", "v2")
    writer.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[written] = path
    return written


def drop_written(df: DataFrame, partition: str = "") -> None:
    """Delete the files behind what ``write_through`` returned, or those of one partition, once nothing will read them."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_written[df]}/{partition}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """What is written in this block takes little disk, and its shuffles go as soon as it is written.

    Without it they stay until the driver happens to collect its garbage. Blocks may be
    nested and run in several threads: the last to end puts the settings back.
    """
    global _blocks
    with _lock:
        if not _blocks:
            _sparing.update({key: spark.conf.get(key, None) for key in SPARING})
            for key, value in SPARING.items():
                spark.conf.set(key, value)
        _blocks += 1
    try:
        yield
    finally:
        with _lock:
            _blocks -= 1
            if not _blocks:
                for key, value in _sparing.items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def in_parallel(job: Callable[[Any], Any], items: Iterable, at_once: int = 4) -> list:
    """Run independent Spark jobs from a few driver threads, results in order.

    The last tasks of one table's job then leave no executors idle while the
    next table waits.
    """
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(job, items))
