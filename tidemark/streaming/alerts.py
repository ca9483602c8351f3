"""Threshold alerts over tumbling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds that alerts are raised above, and the length of a window.
ERROR_THRESHOLD = 5
FAILURE_THRESHOLD = 0
PERIOD = "300 seconds"

_AGGREGATES = {"sum": F.sum, "maximum": F.max}


def window_alerts(
    df: DataFrame,
    ts: str,
    series: str | list[str],
    value: str | Column,
    agg: str = "sum",
    threshold: float = ERROR_THRESHOLD,
    period: str = PERIOD,
) -> DataFrame:
    """Windows in which a series went above its threshold.

    Serves batch and streaming frames alike. A window without rows has no
    alert. Values are summed up per task before the shuffle.
    """
    names = [series] if isinstance(series, str) else list(series)
    value = F.col(value) if isinstance(value, str) else value
    return (
        df.groupBy(F.window(ts, period).alias("_window"), *names)
        .agg(_AGGREGATES[agg](value).alias("observed"))
        .filter(F.col("observed") > threshold)
        .select(
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *names,
            "observed",
        )
    )


def stream_alerts(
    stream: DataFrame,
    ts: str,
    series: str | list[str],
    value: str | Column,
    delay: str = "10 minutes",
    **settings,
) -> DataFrame:
    """The same on a stream: a window is judged once the watermark has passed it."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return window_alerts(timed, ts, series, value, **settings)
