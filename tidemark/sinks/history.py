"""Type-2 history stored in two parts: open versions are swapped, settled ones only added to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.snapshot import VALID_TO, snapshot
from tidemark.session import write_through
from tidemark.sinks.versions import Manifest, VersionedTable

#: The partition column; no source column may be called so.
PART = "_history_part"
OPEN, SETTLED = "open", "settled"


def snapshot_version(
    source: DataFrame,
    root: str,
    key: str,
    updated_at: str | None = None,
    strategy: str = "timestamp",
    check_cols: Sequence[str] | None = None,
    run_at: Column | str | None = None,
    publish: bool = True,
) -> Manifest:
    """One more look at the source, as ``snapshot`` takes it, published as a version of the history.

    A run reads and rewrites the open versions alone. Those it closes, and rows without a
    key, which never meet another one, join the settled part as new files. Both changes
    are one commit.
    """
    spark = source.sparkSession
    table = VersionedTable(spark, root)
    held = table.read(parts=[OPEN]).drop(PART) if table.exists() else None
    after = snapshot(held, source, key, updated_at, strategy, check_cols, run_at)
    stays_open = F.col(VALID_TO).isNull() & F.col(f"`{key}`").isNotNull()
    after = after.withColumn(PART, F.when(stays_open, OPEN).otherwise(SETTLED))
    if held is None:
        return table.replace(after, PART, publish=publish)
    # Written once: the open part is read to make it, and it is the part that is replaced.
    return table.append(write_through(after, "history"), dropping=[OPEN], publish=publish)


def read_history(spark: SparkSession, root: str, version: int | Manifest | None = None, only_open: bool = False) -> DataFrame:
    """All versions of all rows, or the open ones alone."""
    table = VersionedTable(spark, root)
    found = table.read(version, parts=[OPEN] if only_open else None)
    return (found.filter(F.col(VALID_TO).isNull()) if only_open else found).drop(PART)
