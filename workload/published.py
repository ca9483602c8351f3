"""Tables published by commit: rebuilds, merges by sketch, incremental runs and history in two parts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sinks.buckets import join_buckets, store_buckets
from tidemark.sinks.history import read_history, snapshot_version
from tidemark.sinks.tables import as_view, with_loaded_at
from tidemark.sinks.versions import VersionedTable, incremental_version
from workload.incremental import _AFTER, _BEFORE, customers_after, customers_before, first_load, later_load
from workload.inputs import table
from workload.loading import _MERGED, _by_year


def rebuild_partitioned(spark, d):
    """A partitioned table rebuilt with another schema, and then one of its years replaced."""
    orders = VersionedTable(spark, shared_dir(spark, "rebuild"))
    orders.replace(_by_year(first_load(spark, d)), "o_year")
    orders.replace(_by_year(table(spark, d, "orders")).withColumn("rebuilt", F.lit(1)), "o_year")
    orders.swap(orders.read().filter("o_year = 1999").withColumn("rebuilt", F.lit(2)))
    return orders.read()


def merge_by_sketch(spark, d):
    """A merge that learns from the sketch which years hold the keys of the load."""
    orders = VersionedTable(spark, shared_dir(spark, "merge-by-sketch"))
    orders.replace(_by_year(first_load(spark, d)), "o_year", "o_orderkey")
    orders.merge(_by_year(later_load(spark, d)), "o_orderkey")
    return orders.read()


def incremental_published(spark, d):
    """Two runs of an incremental fact whose state is the table itself."""
    root = shared_dir(spark, "incremental")
    for load in (first_load(spark, d), later_load(spark, d)):
        incremental_version(
            _by_year(load), root, "o_orderkey", "o_orderdate", partition_by="o_year", partition_follows_ts=True
        )
    return VersionedTable(spark, root).read()


def _customers_at_last(spark, d):
    """Customers as seen a third time: one in seven has changed again."""
    again = F.col("c_custkey") % 7 == 0
    later = F.expr("updated_at + interval 60 days")
    return customers_after(spark, d).withColumns(
        {
            "c_name": F.when(again, F.concat("c_name", F.lit(" III"))).otherwise(F.col("c_name")),
            "updated_at": F.when(again, later).otherwise(F.col("updated_at")),
        }
    )


def snapshot_three_runs(spark, d):
    """Three looks at the customers; each run writes the open versions and the newly closed ones."""
    root = shared_dir(spark, "history")
    for look in (customers_before, customers_after, _customers_at_last):
        snapshot_version(look(spark, d), root, "c_custkey", "updated_at")
    return read_history(spark, root)


def bucketed_join(spark, d):
    """Lines and their parts stored by the same buckets, the commonest parts salted, and joined without a shuffle."""
    lines, parts = (f"tide_check.{t}_{uuid.uuid4().hex[:12]}" for t in ("lines", "parts"))
    fact = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    store_buckets(fact, table(spark, d, "part"), "p_partkey", "l_shipdate", lines, parts, buckets=16, most_rows=40)
    return join_buckets(spark, lines, parts, "p_partkey").select(
        "l_orderkey", "l_linenumber", "p_partkey", "l_extendedprice", "l_shipdate", "p_name", "p_brand"
    )


def view_with_load_time(spark, d):
    """A view over rows with their load time, which is that of the query."""
    as_view(with_loaded_at(table(spark, d, "orders")), "orders_loaded")
    return spark.sql(
        """SELECT o_orderstatus, count(*) AS n, bool_and(_loaded_at <= localtimestamp()
          AND _loaded_at > localtimestamp() - INTERVAL 1 DAY) AS fresh FROM orders_loaded GROUP BY o_orderstatus"""
    )


QUERIES = {
    "bucketed_join": (
        bucketed_join,
        """SELECT l_orderkey, l_linenumber, l_partkey AS p_partkey, l_extendedprice, l_shipdate, p_name, p_brand
          FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    ),
    "view_with_load_time": (
        view_with_load_time,
        "SELECT o_orderstatus, count(*) AS n, true AS fresh FROM orders GROUP BY o_orderstatus",
    ),
    "rebuild_partitioned": (
        rebuild_partitioned,
        """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year,
          CASE WHEN year(o_orderdate) = 1999 THEN 2 ELSE 1 END AS rebuilt FROM orders""",
    ),
    "merge_by_sketch": (merge_by_sketch, _MERGED),
    "incremental_published": (
        incremental_published,
        """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""",
    ),
    "snapshot_three_runs": (
        snapshot_three_runs,
        f"""WITH third AS (SELECT c_custkey,
            CASE WHEN c_custkey % 7 = 0 THEN c_name || ' III' ELSE c_name END AS c_name, c_acctbal,
            CASE WHEN c_custkey % 7 = 0 THEN updated_at + INTERVAL 60 DAYS ELSE updated_at END AS updated_at
          FROM {_AFTER}),
        looks AS (SELECT 1 AS look, * FROM {_BEFORE} UNION ALL SELECT 2, * FROM {_AFTER} UNION ALL SELECT 3, * FROM third),
        kept AS (SELECT * FROM looks QUALIFY updated_at > coalesce(max(updated_at) OVER (PARTITION BY c_custkey
          ORDER BY look ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TIMESTAMP '1900-01-01'))
        SELECT c_custkey, c_name, c_acctbal, updated_at, updated_at AS dbt_valid_from,
          lead(updated_at) OVER (PARTITION BY c_custkey ORDER BY look) AS dbt_valid_to,
          updated_at AS dbt_updated_at,
          md5(CAST(c_custkey AS VARCHAR) || '|' || CAST(updated_at AS VARCHAR)) AS dbt_scd_id FROM kept""",
    ),
}
