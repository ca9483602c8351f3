"""Merging a stream into a fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.dedup import keep_best
from tidemark.sinks.tables import merge_table
from tidemark.sinks.versions import VersionedTable


def merge_batch(
    batch: DataFrame,
    name: str | VersionedTable,
    key: str | Sequence[str],
    latest: Sequence[Column | str],
    partition_by: str | None = None,
    root: str | None = None,
) -> None:
    """Merge one micro-batch: the best row of each key, by the order ``latest``.

    The table is a catalog table's name, or a versioned table: of that one a batch reads
    only the partitions that its keys may be in.

    A batch that is replayed after a failure merges to the same table. Rows
    without a key match nothing and would be added again; filter them out
    of the stream if it can be replayed.
    """
    numbered = batch.withColumn("_row", F.monotonically_increasing_id())
    best = keep_best(numbered, key, latest, row_id="_row").drop("_row")
    if isinstance(name, str):
        merge_table(best, name, key, partition_by, root=root)
    elif name.exists():
        name.merge(best, key)
    else:
        name.replace(best, partition_by, key if partition_by else None)


def stream_merge(
    stream: DataFrame,
    name: str | VersionedTable,
    key: str | Sequence[str],
    latest: Sequence[Column | str],
    checkpoint: str,
    partition_by: str | None = None,
    root: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a table merged with a stream. Late rows are taken in: the key decides."""

    def merge(batch: DataFrame, _: int) -> None:
        merge_batch(batch, name, key, latest, partition_by, root)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
