"""Learning-event models: staging, dimensions, facts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import duration_seconds, initcap_words, surrogate_key
from tidemark.operators.checks import DataTest
from tidemark.operators.incremental import newer_than_max
from tidemark.operators.reports import newest_first

# ---------------------------------------------------------------------------
# Payload paths with the columns they fill, event categories,
# enrollment channels, scores, and the tests declared on the models.
# ---------------------------------------------------------------------------

PAYLOAD_PATHS = {
    "event_id": ("id", "string"),
    "user_id": ("actor.account.name", "string"),
    "course_id": ("object.id", "string"),
    "event_type": ("verb.id", "string"),
    "event_ts": ("timestamp", "timestamp"),
    "raw_duration": ("result.duration", "string"),
    "rating": ("result.rating", "double"),
    "device_type": ("context.platform", "string"),
    "app_version": ("context.app_version", "string"),
    "user_agent": ("context.device", "string"),
    "ip_address": ("context.ip", "string"),
    "session_id": ("context.session_id", "string"),
}

CATEGORIES = ("view", "start", "complete", "rate")
CHANNELS = ("organic", "paid")
POINTS = {"complete": 5, "start": 3, "view": 1}
MOST_MINUTES = 5
RATING_POINTS = 2

TESTS = (
    DataTest("stg_users", "not_null", "user_id"),
    DataTest("stg_users", "unique", "user_id"),
    DataTest("stg_users", "predicate", "user_id IS NULL"),
    DataTest("stg_courses", "not_null", "course_id"),
    DataTest("stg_courses", "unique", "course_id"),
    DataTest("stg_enrollments", "not_null", "enrollment_id"),
    DataTest("stg_enrollments", "unique", "enrollment_id"),
    DataTest("stg_enrollments", "relationships", "user_id", "stg_users", "user_id"),
    DataTest("stg_enrollments", "relationships", "course_id", "stg_courses", "course_id"),
    DataTest("stg_events", "not_null", "event_id"),
    DataTest("stg_events", "unique", "event_id"),
    DataTest("stg_events", "relationships", "user_id", "stg_users", "user_id"),
    DataTest("stg_events", "relationships", "course_id", "stg_courses", "course_id"),
    DataTest("dim_users", "not_null", "user_sk"),
    DataTest("dim_users", "unique", "user_sk"),
    DataTest("dim_users", "not_null", "user_id"),
    DataTest("dim_users", "unique", "user_id"),
    DataTest("dim_users", "not_null", "country_code"),
    DataTest("dim_courses", "not_null", "course_sk"),
    DataTest("dim_courses", "unique", "course_sk"),
    DataTest("dim_courses", "not_null", "course_id"),
    DataTest("dim_courses", "unique", "course_id"),
    DataTest("dim_courses", "not_null", "category"),
    DataTest("fact_events", "not_null", "event_id"),
    DataTest("fact_events", "unique", "event_id"),
    DataTest("fact_events", "relationships", "user_id", "dim_users", "user_id"),
    DataTest("fact_events", "relationships", "course_id", "dim_courses", "course_id"),
    DataTest("fact_events", "not_null", "is_completed"),
    DataTest("fact_events", "not_null", "safe_time_spent_sec"),
    DataTest("fact_enrollments", "not_null", "enrollment_id"),
    DataTest("fact_enrollments", "unique", "enrollment_id"),
    DataTest("fact_enrollments", "relationships", "user_id", "dim_users", "user_id"),
    DataTest("fact_enrollments", "relationships", "course_id", "dim_courses", "course_id"),
    DataTest("fact_enrollments", "not_null", "enrollment_channel"),
)

# ---------------------------------------------------------------------------


def _timestamp(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz")


def stg_users(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        initcap_words("name").alias("user_name"),
        F.upper("country").alias("country_code"),
        _timestamp("created_at").alias("created_at"),
        surrogate_key("user_id").alias("user_sk"),
    )


def stg_courses(courses: DataFrame) -> DataFrame:
    return courses.select(
        "course_id",
        "title",
        "category",
        "difficulty",
        _timestamp("created_at").alias("created_at"),
        surrogate_key("course_id").alias("course_sk"),
    )


def stg_enrollments(
    enrollments: DataFrame, existing: DataFrame | None = None, lookback: str | None = None
) -> DataFrame:
    staged = enrollments.select(
        "enrollment_id",
        "user_id",
        "course_id",
        _timestamp("enrolled_at").alias("enrolled_at"),
        "enrollment_source",
        surrogate_key("enrollment_id").alias("enrollment_sk"),
    )
    return newer_than_max(staged, existing, "enrolled_at", lookback=lookback)


def stg_events(
    raw: DataFrame, existing: DataFrame | None = None, lookback: str | None = None
) -> DataFrame:
    """Events from a VARIANT ``payload``. A path that is missing, null or of the
    wrong type gives NULL."""
    columns = []
    for name, (path, kind) in PAYLOAD_PATHS.items():
        value = F.try_variant_get("payload", f"$.{path}", kind)
        columns.append((value.cast("timestamp_ntz") if kind == "timestamp" else value).alias(name))
    staged = raw.select(*columns).select(
        "*",
        duration_seconds("raw_duration").alias("time_spent_sec"),
        surrogate_key("event_id").alias("event_sk"),
    )
    return newer_than_max(staged, existing, "event_ts", lookback=lookback)


def stg_events_flat(
    raw: DataFrame, existing: DataFrame | None = None, lookback: str | None = None
) -> DataFrame:
    """Events from a flat table that has the duration as integer seconds."""
    staged = raw.select(
        "event_id",
        "user_id",
        "course_id",
        "event_type",
        _timestamp("event_ts").alias("event_ts"),
        F.col("time_spent_sec").cast("int").alias("time_spent_sec"),
        F.col("rating").cast("decimal(10,2)").alias("rating"),
        "device_type",
        "app_version",
        "user_agent",
        "ip_address",
        "session_id",
        surrogate_key("event_id").alias("event_sk"),
    )
    return newer_than_max(staged, existing, "event_ts", lookback=lookback)


def dim_users(stg: DataFrame) -> DataFrame:
    return stg.select(
        surrogate_key("user_id").alias("user_sk"),
        "user_id",
        "user_name",
        "country_code",
        "created_at",
    )


def dim_courses(stg: DataFrame) -> DataFrame:
    return stg.select(
        surrogate_key("course_id").alias("course_sk"),
        "course_id",
        "title",
        "category",
        "difficulty",
        "created_at",
    )


def enrollment_channel(source: Column | str) -> Column:
    """The first channel the source names; unknown when it names none or is NULL."""
    source = F.col(source) if isinstance(source, str) else source
    channel = F.when(source.ilike(f"%{CHANNELS[0]}%"), CHANNELS[0])
    for name in CHANNELS[1:]:
        channel = channel.when(source.ilike(f"%{name}%"), name)
    return channel.otherwise("unknown")


def fact_enrollments(
    stg: DataFrame, existing: DataFrame | None = None, lookback: str | None = None
) -> DataFrame:
    fact = stg.select(
        surrogate_key("enrollment_id").alias("enrollment_sk"),
        "enrollment_id",
        "user_id",
        "course_id",
        "enrolled_at",
        "enrollment_source",
        enrollment_channel("enrollment_source").alias("enrollment_channel"),
    )
    return newer_than_max(fact, existing, "enrolled_at", lookback=lookback)


def engagement_score(event_type: Column, seconds: Column, rating: Column) -> Column:
    """Points for the kind of event, the minutes spent up to a bound, and a rating."""
    score = F.lit(0)
    for kind, points in POINTS.items():
        score = score + F.when(event_type == kind, points).otherwise(0)
    # Integer division: only whole minutes count.
    minutes = F.call_function("div", F.coalesce(seconds, F.lit(0)), F.lit(60))
    score = score + F.least(minutes, F.lit(MOST_MINUTES))
    return (score + F.when(rating > 0, RATING_POINTS).otherwise(0)).cast("int")


def fact_events(
    stg: DataFrame, existing: DataFrame | None = None, lookback: str | None = None
) -> DataFrame:
    kind, seconds, rating = F.col("event_type"), F.col("time_spent_sec"), F.col("rating")
    fact = stg.select(
        surrogate_key("event_id").alias("event_sk"),
        "event_id",
        "user_id",
        "course_id",
        "event_type",
        "event_ts",
        "time_spent_sec",
        "rating",
        "device_type",
        "app_version",
        "ip_address",
        "session_id",
        F.when(kind == "complete", 1).otherwise(0).alias("is_completed"),
        F.when(rating > 0, 1).otherwise(0).alias("has_rating"),
        F.nullif(rating, F.lit(0).cast(stg.schema["rating"].dataType)).alias("safe_rating"),
        F.greatest(F.coalesce(seconds, F.lit(0)), F.lit(0)).alias("safe_time_spent_sec"),
        F.when(kind.isin(*CATEGORIES), kind).otherwise("other").alias("event_category"),
        engagement_score(kind, seconds, rating).alias("engagement_score"),
    )
    return newer_than_max(fact, existing, "event_ts", lookback=lookback)


def daily_active_learners(fact: DataFrame) -> DataFrame:
    """Distinct users per day, newest day first."""
    daily = fact.groupBy(F.to_date("event_ts").alias("event_date")).agg(
        F.count_distinct("user_id").alias("daily_active_learners")
    )
    return newest_first(daily, "event_date")


def weekly_active_learners(fact: DataFrame) -> DataFrame:
    """Distinct users per ISO week, by its Monday."""
    week = F.date_trunc("week", F.col("event_ts")).cast("date")
    weekly = fact.groupBy(week.alias("week_start")).agg(
        F.count_distinct("user_id").alias("weekly_active_learners")
    )
    return newest_first(weekly, "week_start")


def course_completion_rates(fact: DataFrame) -> DataFrame:
    """Per course, the share of users who completed it among those who started or completed.

    Counted per user first: one aggregation on (course, user), one on the course.
    """
    completed = F.col("event_type") == "complete"
    started = (F.col("event_type") == "start") | completed
    users = (
        fact.filter(started & F.col("user_id").isNotNull())
        .groupBy("course_id", "user_id")
        .agg(F.max(completed.cast("int")).alias("completed"))
    )
    return users.groupBy("course_id").agg(
        F.count(F.lit(1)).alias("learners"),
        F.sum("completed").alias("completed_learners"),
        (F.sum("completed") / F.count(F.lit(1))).alias("completion_rate"),
    )
