"""The star-schema tables, and the stand-ins for source tables made from them.

Each stand-in has a DataFrame and the same thing as SQL for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dealt_out(df: DataFrame, *by: str) -> DataFrame:
    """The rows dealt to many tasks by a shuffle, unless the files deal them to enough already.

    That is so if no task reads more than one and a half times a core's share. Only the footers
    of the files are read to find out: a file may be cut into many splits and yet be one row group.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows"))
    most, total = tasks.agg(F.max("rows"), F.sum("rows")).first()
    return df if most is not None and 2 * cores * most <= 3 * total else df.repartition(*by)


def users(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    return table(spark, d, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.concat_ws("-", F.lower("c_mktsegment"), F.upper("c_name")).alias("name"),
        F.lower("n_name").alias("country"),
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(c_custkey % 1000 as int))").alias(
            "created_at"
        ),
    )


USERS = """(SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  lower(c_mktsegment) || '-' || upper(c_name) AS name, lower(n_name) AS country,
  TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER)) AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def courses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("course_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("difficulty"),
        F.expr("timestamp_ntz'2021-01-01' + make_dt_interval(p_size)").alias("created_at"),
    )


COURSES = """(SELECT CAST(p_partkey AS VARCHAR) AS course_id, p_name AS title,
  p_type AS category, p_brand AS difficulty,
  TIMESTAMP '2021-01-01' + to_days(p_size) AS created_at FROM part)"""


def enrollments(spark: SparkSession, d: str) -> DataFrame:
    source = F.expr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Paid-Ads' WHEN '2-HIGH' THEN 'ORGANIC_search'"
        " WHEN '3-MEDIUM' THEN 'paid organic' WHEN '5-LOW' THEN NULL ELSE 'email' END"
    )
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("enrollment_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.floor(F.col("o_totalprice") / 1000).cast("string").alias("course_id"),
        F.col("o_orderdate").alias("enrolled_at"),
        source.alias("enrollment_source"),
    )


ENROLLMENTS = """(SELECT CAST(o_orderkey AS VARCHAR) AS enrollment_id,
  CAST(o_custkey AS VARCHAR) AS user_id,
  CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS course_id,
  o_orderdate AS enrolled_at,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Paid-Ads' WHEN '2-HIGH' THEN 'ORGANIC_search'
    WHEN '3-MEDIUM' THEN 'paid organic' WHEN '5-LOW' THEN NULL ELSE 'email' END
    AS enrollment_source FROM orders)"""

_KIND = (
    "CASE event_type WHEN 'signup' THEN 'start' WHEN 'purchase' THEN 'complete'"
    " WHEN 'click' THEN 'rate' WHEN 'error' THEN NULL ELSE event_type END"
)


def flat_events(spark: SparkSession, d: str) -> DataFrame:
    """Learning events in the flat form: seconds may be negative or missing, ratings 0."""
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("course_id"),
        F.expr(_KIND).alias("event_type"),
        F.col("ts").alias("event_ts"),
        F.expr(
            "CASE WHEN event_type = 'signup' THEN NULL"
            " ELSE cast(floor(value * 60) as int) - 120 END"
        ).alias("time_spent_sec"),
        F.expr(
            "CASE WHEN event_type IN ('click', 'purchase') THEN cast(cast(floor(value) as int) % 6"
            " as double) END"
        ).alias("rating"),
        F.expr("CASE WHEN value < 5 THEN 'ios' ELSE 'web' END").alias("device_type"),
        F.lit("1.0").alias("app_version"),
        F.lit("agent").alias("user_agent"),
        F.concat(F.lit("10.0.0."), F.get_json_object("props", "$.k")).alias("ip_address"),
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"),
    )


FLAT_EVENTS = f"""(SELECT CAST(event_id AS VARCHAR) AS event_id,
  CAST(user_id AS VARCHAR) AS user_id,
  json_extract_string(props, '$.k') AS course_id, {_KIND} AS event_type, ts AS event_ts,
  CASE WHEN event_type = 'signup' THEN NULL
    ELSE CAST(floor(value * 60) AS INTEGER) - 120 END AS time_spent_sec,
  CASE WHEN event_type IN ('click', 'purchase')
    THEN CAST(CAST(floor(value) AS INTEGER) % 6 AS DOUBLE) END AS rating,
  CASE WHEN value < 5 THEN 'ios' ELSE 'web' END AS device_type, '1.0' AS app_version,
  'agent' AS user_agent, '10.0.0.' || json_extract_string(props, '$.k') AS ip_address,
  's' || CAST(user_id AS VARCHAR) AS session_id FROM events)"""


def duration_text(seconds):
    """A duration as a source may send it: ISO 8601 or a plain number."""
    return (
        F.when(seconds < 0, seconds.cast("string"))
        .when(seconds >= 60, F.format_string("PT%dM%dS", F.expr("time_spent_sec div 60"), seconds % 60))
        .otherwise(F.concat(F.lit("PT"), seconds.cast("string"), F.lit("S")))
    )


def raw_events(spark: SparkSession, d: str) -> DataFrame:
    """The same events as JSON text, nested like the statements of an event source."""
    document = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.struct(F.col("user_id").alias("name")).alias("account")).alias("actor"),
        F.struct(F.col("course_id").alias("id")).alias("object"),
        F.struct(F.col("event_type").alias("id")).alias("verb"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(
            duration_text(F.col("time_spent_sec")).alias("duration"), F.col("rating")
        ).alias("result"),
        F.struct(
            F.col("device_type").alias("platform"),
            "app_version",
            F.col("user_agent").alias("device"),
            F.col("ip_address").alias("ip"),
            "session_id",
        ).alias("context"),
    )
    # The table may be a few row groups; its rows are dealt out as the files of an event source would be.
    return flat_events(spark, d).repartition("event_id").select(F.to_json(document).alias("value"))
