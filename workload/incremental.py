"""High-water marks, merges, schema evolution and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import incremental, snapshot
from workload.inputs import table

# Orders delivered in two loads that overlap by a year. In the later load the
# orders of that year have a changed price.
FIRST = "(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
LATER = """(SELECT * REPLACE (CASE WHEN o_orderdate < TIMESTAMP '2000-01-01'
  THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')"""


def first_load(spark, d):
    return table(spark, d, "orders").filter("o_orderdate < timestamp_ntz'2000-01-01'")


def later_load(spark, d):
    overlap = F.col("o_orderdate") < F.expr("timestamp_ntz'2000-01-01'")
    return (
        table(spark, d, "orders")
        .filter("o_orderdate >= timestamp_ntz'1999-01-01'")
        .withColumn(
            "o_totalprice",
            F.when(overlap, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        )
    )


def high_water_mark(spark, d):
    mark = incremental.high_water_mark(first_load(spark, d), "o_orderdate")
    return mark.withColumnRenamed("o_orderdate", "mark")


def incremental_filter(spark, d):
    return incremental.newer_than_max(
        later_load(spark, d), first_load(spark, d), "o_orderdate"
    )


def incremental_lookback(spark, d):
    return incremental.newer_than_max(
        later_load(spark, d), first_load(spark, d), "o_orderdate", lookback="30 days"
    )


def merge_upsert(spark, d):
    return incremental.merge_upsert(first_load(spark, d), later_load(spark, d), "o_orderkey")


def delete_insert(spark, d):
    # Every changed order comes twice; both rows are kept.
    source = later_load(spark, d)
    again = source.withColumn("o_orderstatus", F.lit("X"))
    return incremental.delete_insert(
        first_load(spark, d), source.unionByName(again), "o_orderkey"
    )


def append_new_columns(spark, d):
    source = later_load(spark, d).drop("o_orderpriority").withColumn(
        "o_year", F.year("o_orderdate")
    )
    return incremental.merge_upsert(first_load(spark, d), source, "o_orderkey")


def customers_before(spark, d):
    """Customers as seen first: one market segment is not there yet."""
    return table(spark, d, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(c_custkey % 1000 as int))").alias(
            "updated_at"
        ),
    )


def customers_after(spark, d):
    """Customers as seen next: one segment is gone, well-off customers have changed,
    and some of those changed without a newer time."""
    rich = F.col("c_acctbal") > 5000
    return table(spark, d, "customer").filter("c_mktsegment <> 'MACHINERY'").select(
        "c_custkey",
        F.when(rich, F.concat("c_name", F.lit(" II"))).otherwise(F.col("c_name")).alias("c_name"),
        "c_acctbal",
        F.when(
            F.col("c_acctbal") > 6000,
            F.expr("timestamp_ntz'2020-01-31' + make_dt_interval(cast(c_custkey % 1000 as int))"),
        )
        .otherwise(
            F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(c_custkey % 1000 as int))")
        )
        .alias("updated_at"),
    )


_BEFORE = """(SELECT c_custkey, c_name, c_acctbal,
  TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER)) AS updated_at
  FROM customer WHERE c_mktsegment <> 'BUILDING')"""
_AFTER = """(SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name || ' II' ELSE c_name END
  AS c_name, c_acctbal,
  CASE WHEN c_acctbal > 6000 THEN TIMESTAMP '2020-01-31' ELSE TIMESTAMP '2020-01-01' END
  + to_days(CAST(c_custkey % 1000 AS INTEGER)) AS updated_at
  FROM customer WHERE c_mktsegment <> 'MACHINERY')"""


def snapshot_timestamp(spark, d):
    history = snapshot.snapshot(None, customers_before(spark, d), "c_custkey", "updated_at")
    return snapshot.snapshot(history, customers_after(spark, d), "c_custkey", "updated_at")


def snapshot_check(spark, d):
    history = snapshot.snapshot(
        None,
        customers_before(spark, d),
        "c_custkey",
        strategy="check",
        run_at="2024-01-01 00:00:00",
    )
    return snapshot.snapshot(
        history,
        customers_after(spark, d),
        "c_custkey",
        strategy="check",
        run_at="2024-02-01 00:00:00",
    )


def _history_sql(since_old: str, since_new: str, changed: str) -> str:
    def version(t, since, until):
        return f"""SELECT {t}.c_custkey, {t}.c_name, {t}.c_acctbal, {t}.updated_at,
          {since} AS dbt_valid_from, {until} AS dbt_valid_to, {since} AS dbt_updated_at,
          md5(CAST({t}.c_custkey AS VARCHAR) || '|' || CAST({since} AS VARCHAR)) AS dbt_scd_id"""

    until = f"CASE WHEN a.c_custkey IS NOT NULL AND ({changed}) THEN {since_new} END"
    return f"""{version('b', since_old, until)}
      FROM {_BEFORE} b LEFT JOIN {_AFTER} a ON a.c_custkey = b.c_custkey
      UNION ALL
      {version('a', since_new, 'CAST(NULL AS TIMESTAMP)')}
      FROM {_AFTER} a LEFT JOIN {_BEFORE} b ON a.c_custkey = b.c_custkey
      WHERE b.c_custkey IS NULL OR ({changed})"""


def validity_ranges(spark, d):
    orders = table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"
    )
    return snapshot.validity_ranges(orders, "o_custkey", "o_orderdate", ["o_orderkey"])


QUERIES = {
    "high_water_mark": (
        high_water_mark,
        f"SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') AS mark FROM {FIRST}",
    ),
    "incremental_filter": (
        incremental_filter,
        f"""SELECT * FROM {LATER} WHERE o_orderdate >
          (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM {FIRST})""",
    ),
    "incremental_lookback": (
        incremental_lookback,
        f"""SELECT * FROM {LATER} WHERE o_orderdate >
          (SELECT max(o_orderdate) - INTERVAL 30 DAY FROM {FIRST})""",
    ),
    "merge_upsert": (
        merge_upsert,
        f"""SELECT * FROM {FIRST} t WHERE NOT EXISTS
          (SELECT 1 FROM {LATER} s WHERE s.o_orderkey = t.o_orderkey)
          UNION ALL SELECT * FROM {LATER}""",
    ),
    "delete_insert": (
        delete_insert,
        f"""SELECT * FROM {FIRST} t WHERE NOT EXISTS
          (SELECT 1 FROM {LATER} s WHERE s.o_orderkey = t.o_orderkey)
          UNION ALL SELECT * FROM {LATER}
          UNION ALL SELECT * REPLACE ('X' AS o_orderstatus) FROM {LATER}""",
    ),
    "append_new_columns": (
        append_new_columns,
        f"""SELECT *, CAST(NULL AS INTEGER) AS o_year FROM {FIRST} t WHERE NOT EXISTS
          (SELECT 1 FROM {LATER} s WHERE s.o_orderkey = t.o_orderkey)
          UNION ALL BY NAME SELECT * EXCLUDE (o_orderpriority),
            CAST(year(o_orderdate) AS INTEGER) AS o_year FROM {LATER}""",
    ),
    "snapshot_timestamp": (
        snapshot_timestamp,
        _history_sql("b.updated_at", "a.updated_at", "a.updated_at > b.updated_at"),
    ),
    "snapshot_check": (
        snapshot_check,
        _history_sql(
            "TIMESTAMP '2024-01-01'",
            "TIMESTAMP '2024-02-01'",
            "a.c_name <> b.c_name OR a.c_acctbal <> b.c_acctbal OR a.updated_at <> b.updated_at",
        ),
    ),
    "validity_ranges": (
        validity_ranges,
        """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate, o_orderdate AS valid_from,
          lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
            AS valid_to FROM orders""",
    ),
}
