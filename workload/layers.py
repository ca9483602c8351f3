"""All learning models over two loads, as DataFrames and as versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.layers import check_layers, publish_layers, run_layers
from tidemark.plans.learning import TESTS
from tidemark.session import shared_dir, write_through
from tidemark.sources.files import variant_payload
from workload import inputs
from workload.inputs import ENROLLMENTS, FLAT_EVENTS, USERS
from workload.quality import tests_sql

SPLIT = "2024-01-16"


def _loads(spark, d):
    """Two loads. The second one brings newer events, and courses seen anew."""
    # The events lie in files, like those of an event source. Over the plan that makes them every
    # filter on an event would be moved to the scan, and make and parse its text once more.
    newer = F.get_json_object("value", "$.timestamp") >= SPLIT
    events = write_through(
        inputs.raw_events(spark, d).select(variant_payload("value").alias("payload"), newer.alias("newer")),
        "raw-events",
        most_rows=100_000,
    )

    def load(events, enrollments):
        return {
            "users": inputs.users(spark, d),
            "courses": inputs.courses(spark, d),
            "enrollments": enrollments,
            "events": events.select("payload"),
        }

    enrollments = inputs.enrollments(spark, d)
    early = F.col("enrolled_at") < F.lit("1999-01-01").cast("timestamp_ntz")
    return (
        load(events.filter("NOT newer"), enrollments.filter(early)),
        load(events.filter("newer"), enrollments.filter(~early)),
    )


def _after_two_runs(spark, d):
    """The second run finds the incremental tables of the first one written."""
    first, second = _loads(spark, d)
    kept = {
        name: write_through(df, name)
        for name, df in run_layers(first).items()
        if name in ("stg_events", "fact_events", "stg_enrollments", "fact_enrollments")
    }
    return run_layers(second, kept, keep=lambda name, df: write_through(df, name))


def layers_fact_events(spark, d):
    return _after_two_runs(spark, d)["fact_events"].select("event_id", "event_ts", "engagement_score")


def layers_data_tests(spark, d):
    """All declared tests over the tables after two runs; those of courses fail."""
    return check_layers(_after_two_runs(spark, d), TESTS)


def materialized_layers(spark, d):
    """Both loads into versioned tables, gated by the tests of keys; the reports are read back."""
    suite = [t for t in TESTS if t.kind in ("not_null", "unique")]
    root = shared_dir(spark, "layers")
    for load in _loads(spark, d):
        tables = publish_layers(spark, load, root, grain="month", suite=suite)
    daily = tables["daily_active_learners"].read()
    facts = tables["fact_enrollments"].read().groupBy("enrollment_channel").agg(F.count(F.lit(1)).alias("n"))
    history = tables["users_snapshot"].read().agg(F.count(F.lit(1)).alias("n"))
    return (
        daily.select(
            F.lit("daily").alias("what"),
            F.col("event_date").cast("string").alias("label"),
            F.col("daily_active_learners").alias("n"),
        )
        .unionByName(
            facts.select(
                F.lit("channel").alias("what"), F.col("enrollment_channel").alias("label"), "n"
            )
        )
        .unionByName(history.select(F.lit("history").alias("what"), F.lit("users").alias("label"), "n"))
    )


QUERIES = {
    "layers_fact_events": (
        layers_fact_events,
        f"""SELECT event_id, event_ts,
          CAST(CASE event_type WHEN 'complete' THEN 5 WHEN 'start' THEN 3 WHEN 'view' THEN 1
            ELSE 0 END + least(CAST(trunc(coalesce(time_spent_sec, 0) / 60) AS INTEGER), 5)
            + CASE WHEN rating > 0 THEN 2 ELSE 0 END AS INTEGER) AS engagement_score
          FROM {FLAT_EVENTS}""",
    ),
    "layers_data_tests": (layers_data_tests, tests_sql(USERS)),
    "materialized_layers": (
        materialized_layers,
        f"""SELECT 'daily' AS what, CAST(CAST(event_ts AS DATE) AS VARCHAR) AS label,
            count(DISTINCT user_id) AS n FROM {FLAT_EVENTS} GROUP BY 2
          UNION ALL SELECT 'channel',
            CASE WHEN enrollment_source ILIKE '%organic%' THEN 'organic'
              WHEN enrollment_source ILIKE '%paid%' THEN 'paid' ELSE 'unknown' END, count(*)
            FROM {ENROLLMENTS} GROUP BY 2
          UNION ALL SELECT 'history', 'users', count(*) FROM {USERS}""",
    ),
}
