"""Sorted sweep over range partitions: the latest mark at or before each point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import write_through


def latest_mark(points: DataFrame, marks: DataFrame, key: list[str], tie: list[str], strict: bool = False) -> DataFrame:
    """``points`` with column ``mark``: that of the last row of ``marks`` with key <= theirs, or < if ``strict``.

    ``marks`` has the columns of ``key`` and a column ``mark``. At equal keys marks
    come first, or last if ``strict``; of several, the one with the greatest ``mark`` is the last. ``tie``
    names columns of ``points`` that tell rows of one key apart, so a key that
    holds many rows is spread over several ranges. Points before every mark get NULL.

    Points and marks are dealt into ranges of the key, each range is swept by
    itself, and what is open at the end of a range is carried to the next: one
    row for each range. No range has to hold all rows of a key.
    """
    spark = points.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mark_kind = 2 if strict else 0
    kinds = dict(marks.select("mark").dtypes)
    rows = points.select(
        *key,
        F.lit(1).alias("_kind"),
        F.xxhash64(*tie).alias("_tie"),
        F.struct(*points.columns).alias("_point"),
        F.lit(None).cast(kinds["mark"]).alias("mark"),
    )
    events = rows.unionByName(
        marks.select(*key, F.lit(mark_kind).alias("_kind"), F.lit(0).cast("long").alias("_tie"), "mark"),
        allowMissingColumns=True,
    )
    order = [*key, "_kind", "_tie", "mark"]
    dealt = events.repartitionByRange(n, *key, "_kind", "_tie").withColumn(
        "_range", F.spark_partition_id()
    )
    dealt = write_through(dealt, "sweep")
    ends = (
        dealt.groupBy("_range")
        .agg(
            F.max_by(
                F.when(F.col("_kind") == mark_kind, F.col("mark")),
                F.when(F.col("_kind") == mark_kind, F.struct(*key, "mark")),
            ).alias("_end")
        )
        .select(
            "_range",
            F.last("_end", ignorenulls=True)
            .over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
            .alias("_carried"),
        )
    )
    in_range = Window.partitionBy("_range").orderBy(*order)
    return (
        dealt.withColumn("_seen", F.last("mark", ignorenulls=True).over(in_range))
        .filter("_kind = 1")
        .join(ends, "_range")
        .select("_point.*", F.coalesce("_seen", "_carried").alias("mark"))
    )
