"""Audit and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_first(df: DataFrame, c: str) -> DataFrame:
    """Sorted descending with NULL first, as warehouses of the Postgres family do."""
    return df.orderBy(F.desc_nulls_first(c))


def batch_audit(df: DataFrame, batch: str = "batch_id", ok: Column | None = None) -> DataFrame:
    """Rows written per batch; a batch with a row that is not ``ok`` has failed."""
    good = F.lit(True) if ok is None else F.coalesce(ok, F.lit(False))
    return (
        df.groupBy(F.col(batch).alias("batch_id"))
        .agg(
            F.count_if(good).alias("records_written"),
            F.count_if(~good).alias("records_failed"),
        )
        .select(
            "batch_id",
            F.when(F.col("records_failed") == 0, "SUCCEEDED").otherwise("FAILED").alias("status"),
            "records_written",
            "records_failed",
        )
    )


def dq_report(checked: DataFrame, table: str | Column = "table") -> DataFrame:
    """Rows in all, passed and failed, and rows per broken rule, for each table.

    Every row adds to two counters of its table or more; all are counted in
    one aggregation.
    """
    name = F.col(table) if isinstance(table, str) else table
    verdict = F.when(F.size("reasons") == 0, "passed").otherwise("failed")
    return (
        checked.select(
            name.alias("table"),
            F.explode(F.concat(F.array(F.lit("rows"), verdict), "reasons")).alias("rule"),
        )
        .groupBy("table", "rule")
        .agg(F.count(F.lit(1)).alias("n"))
    )
