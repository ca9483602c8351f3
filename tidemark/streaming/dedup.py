"""Removing repeats from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_dedup(
    stream: DataFrame, key: str | list[str], ts: str, delay: str = "1 hour", presplit: bool = False
) -> DataFrame:
    """The first row of each key; repeats within ``delay`` of it are dropped.

    Each key is held in state once. With ``presplit`` repeats are first dropped per input
    partition, so a key that is repeated very often sends one row per partition to the
    last step and not all of them to one task; its state is then held once per partition more.
    """
    keys = [key] if isinstance(key, str) else list(key)
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    if presplit:
        timed = (
            timed.withColumn("_part", F.spark_partition_id())
            .dropDuplicatesWithinWatermark([*keys, "_part"])
            .drop("_part")
        )
    return timed.dropDuplicatesWithinWatermark(keys)
