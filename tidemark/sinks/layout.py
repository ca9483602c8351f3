"""How facts are laid out in files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cluster_fact(df: DataFrame, key: str, ts: str, partitions: int | None = None) -> DataFrame:
    """Rows grouped by key and sorted by time in every file.

    Ranges over (key, time) keep a key together where it fits one file, and
    spread a key with very many rows over several, each with its own span of
    time. Both columns then have tight minima and maxima for file pruning.
    Finding the ranges reads the input once more, so give it written rows.
    """
    ranged = (
        df.repartitionByRange(partitions, key, ts) if partitions else df.repartitionByRange(key, ts)
    )
    return ranged.sortWithinPartitions(key, ts)
