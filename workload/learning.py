"""Staging, dimensions, facts and reports of learning events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import duration_seconds
from tidemark.plans import learning
from tidemark.sources.files import variant_payload
from workload import inputs
from workload.inputs import COURSES, ENROLLMENTS, FLAT_EVENTS, USERS

_INITCAP = (
    "array_to_string(list_transform(regexp_extract_all(lower(name),"
    " '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+'), lambda w: upper(w[1]) || w[2:]), '')"
)
STG_USERS = f"""SELECT user_id, {_INITCAP} AS user_name, upper(country) AS country_code,
  created_at, md5(user_id) AS user_sk FROM {USERS}"""
STG_COURSES = f"""SELECT course_id, title, category, difficulty, created_at,
  md5(course_id) AS course_sk FROM {COURSES}"""
STG_ENROLLMENTS = f"""SELECT enrollment_id, user_id, course_id, enrolled_at, enrollment_source,
  md5(enrollment_id) AS enrollment_sk FROM {ENROLLMENTS}"""
FACT_EVENTS = f"""SELECT md5(event_id) AS event_sk, event_id, user_id, course_id, event_type,
  event_ts, time_spent_sec, rating, device_type, app_version, ip_address, session_id,
  CASE WHEN event_type = 'complete' THEN 1 ELSE 0 END AS is_completed,
  CASE WHEN rating > 0 THEN 1 ELSE 0 END AS has_rating,
  nullif(rating, 0) AS safe_rating,
  greatest(coalesce(time_spent_sec, 0), 0) AS safe_time_spent_sec,
  CASE WHEN event_type IN ('view', 'start', 'complete', 'rate') THEN event_type ELSE 'other' END
    AS event_category,
  CAST(CASE event_type WHEN 'complete' THEN 5 WHEN 'start' THEN 3 WHEN 'view' THEN 1 ELSE 0 END
    + least(CAST(trunc(coalesce(time_spent_sec, 0) / 60) AS INTEGER), 5)
    + CASE WHEN rating > 0 THEN 2 ELSE 0 END AS INTEGER) AS engagement_score
  FROM {FLAT_EVENTS}"""


def stg_users(spark, d):
    return learning.stg_users(inputs.users(spark, d))


def stg_courses(spark, d):
    return learning.stg_courses(inputs.courses(spark, d))


def stg_enrollments(spark, d):
    return learning.stg_enrollments(inputs.enrollments(spark, d))


def stg_events_flat(spark, d):
    staged = learning.stg_events_flat(inputs.flat_events(spark, d))
    return staged.withColumn("rating", F.col("rating").cast("double"))


def stg_events_variant(spark, d):
    raw = inputs.raw_events(spark, d).select(variant_payload("value").alias("payload"))
    return learning.stg_events(raw).drop("raw_duration")


def duration_text(spark, d):
    events = inputs.flat_events(spark, d)
    text = inputs.duration_text(F.col("time_spent_sec"))
    return events.select("event_id", duration_seconds(text).alias("seconds"))


def fact_events_frame(spark, d):
    staged = learning.stg_events_flat(inputs.flat_events(spark, d))
    return learning.fact_events(staged.withColumn("rating", F.col("rating").cast("double")))


def dim_users(spark, d):
    return learning.dim_users(stg_users(spark, d))


def dim_courses(spark, d):
    return learning.dim_courses(stg_courses(spark, d))


def fact_enrollments(spark, d):
    return learning.fact_enrollments(stg_enrollments(spark, d))


def daily_active_learners(spark, d):
    return learning.daily_active_learners(fact_events_frame(spark, d))


def weekly_active_learners(spark, d):
    return learning.weekly_active_learners(fact_events_frame(spark, d))


def course_completion_rates(spark, d):
    rates = learning.course_completion_rates(fact_events_frame(spark, d))
    return rates.withColumn("completion_rate", F.round("completion_rate", 9))


QUERIES = {
    "stg_users": (stg_users, STG_USERS),
    "stg_courses": (stg_courses, STG_COURSES),
    "stg_enrollments": (stg_enrollments, STG_ENROLLMENTS),
    "stg_events_flat": (
        stg_events_flat,
        f"SELECT *, md5(event_id) AS event_sk FROM {FLAT_EVENTS}",
    ),
    "stg_events_variant": (
        stg_events_variant,
        f"SELECT *, md5(event_id) AS event_sk FROM {FLAT_EVENTS}",
    ),
    "duration_text": (
        duration_text,
        f"SELECT event_id, time_spent_sec AS seconds FROM {FLAT_EVENTS}",
    ),
    "dim_users": (
        dim_users,
        f"SELECT user_sk, user_id, user_name, country_code, created_at FROM ({STG_USERS})",
    ),
    "dim_courses": (
        dim_courses,
        f"SELECT course_sk, course_id, title, category, difficulty, created_at FROM ({STG_COURSES})",
    ),
    "fact_enrollments": (
        fact_enrollments,
        f"""SELECT *, CASE WHEN enrollment_source ILIKE '%organic%' THEN 'organic'
          WHEN enrollment_source ILIKE '%paid%' THEN 'paid' ELSE 'unknown' END
          AS enrollment_channel FROM ({STG_ENROLLMENTS})""",
    ),
    "fact_events": (fact_events_frame, FACT_EVENTS),
    "daily_active_learners": (
        daily_active_learners,
        f"""SELECT CAST(event_ts AS DATE) AS event_date,
          count(DISTINCT user_id) AS daily_active_learners FROM {FLAT_EVENTS} GROUP BY 1""",
    ),
    "weekly_active_learners": (
        weekly_active_learners,
        f"""SELECT CAST(date_trunc('week', event_ts) AS DATE) AS week_start,
          count(DISTINCT user_id) AS weekly_active_learners FROM {FLAT_EVENTS} GROUP BY 1""",
    ),
    "course_completion_rates": (
        course_completion_rates,
        f"""SELECT course_id,
          count(DISTINCT CASE WHEN event_type IN ('start', 'complete') THEN user_id END) AS learners,
          count(DISTINCT CASE WHEN event_type = 'complete' THEN user_id END) AS completed_learners,
          round(count(DISTINCT CASE WHEN event_type = 'complete' THEN user_id END) /
            count(DISTINCT CASE WHEN event_type IN ('start', 'complete') THEN user_id END), 9)
            AS completion_rate
          FROM {FLAT_EVENTS} WHERE event_type IN ('start', 'complete') GROUP BY 1""",
    ),
}
