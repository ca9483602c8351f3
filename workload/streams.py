"""Streaming forms, run to the end of their input and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sources.registry import load_registry
from tidemark.streaming.alerts import stream_alerts, window_alerts
from tidemark.sinks.versions import VersionedTable
from tidemark.streaming.dedup import stream_dedup
from tidemark.streaming.landing import stream_land
from tidemark.streaming.merge import stream_merge
from workload import inputs
from workload.inputs import ENROLLMENTS, table

THRESHOLD = 20.0


def event_stream(spark, d):
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def _finish(stream, out: str):
    """Run a stream over all that is there, into files; a cluster's sink like any other."""
    (
        stream.writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows")


def _plain_times(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def window_threshold_alert(spark, d):
    alerts = window_alerts(
        table(spark, d, "events"), "ts", "event_type", F.lit(1), threshold=1
    )
    return alerts


def window_maximum_alert(spark, d):
    return window_alerts(
        table(spark, d, "events"), "ts", "event_type", "value", agg="maximum", threshold=THRESHOLD
    )


def stream_window_alert(spark, d):
    """Windows end before the watermark, ten minutes behind the newest event."""
    alerts = stream_alerts(
        event_stream(spark, d), "ts", "event_type", F.lit(1), threshold=1, delay="10 minutes"
    )
    return _plain_times(
        _finish(alerts, shared_dir(spark, "alerts")), "window_start", "window_end"
    )


def stream_dedup_events(spark, d):
    """Every event delivered twice, kept once."""
    stream = event_stream(spark, d)
    once = stream_dedup(stream.union(event_stream(spark, d)), "event_id", "ts", "60 days")
    return _plain_times(_finish(once, shared_dir(spark, "dedup")), "ts")


def _events_and_fixes(spark, d):
    first = event_stream(spark, d).withColumn("version", F.lit(1))
    fixed = (
        event_stream(spark, d)
        .filter("event_type = 'purchase'")
        .withColumns({"version": F.lit(2), "value": F.col("value") + 1})
    )
    return first.union(fixed).withColumn("event_date", F.to_date("ts"))


def stream_merge_events(spark, d):
    """Events, and corrected copies of purchases, merged into one table by key."""
    name = f"tide_check.merged_{uuid.uuid4().hex[:12]}"
    root = shared_dir(spark, "stream-merge")
    stream_merge(
        _events_and_fixes(spark, d),
        name,
        "event_id",
        [F.col("version").desc()],
        f"{root}/checkpoint",
        partition_by="event_date",
        root=f"{root}/table",
    ).awaitTermination()
    return spark.table(name)


def stream_merge_published(spark, d):
    """The same stream into a versioned table, whose batches read only the days their keys may be in."""
    root = shared_dir(spark, "stream-merge")
    target = VersionedTable(spark, f"{root}/table")
    latest = [F.col("version").desc()]
    for run in ("first", "again"):
        # The second stream has a checkpoint of its own, so it merges every row once more.
        stream_merge(
            _events_and_fixes(spark, d), target, "event_id", latest, f"{root}/{run}", partition_by="event_date"
        ).awaitTermination()
    return target.read()


def stream_land_files(spark, d):
    """Dated folders landed by a stream, and landed again without doubling a row."""
    root = shared_dir(spark, "land")
    enrollments = inputs.enrollments(spark, d)
    for date, half in (("2024-03-01", "<"), ("2024-03-02", ">=")):
        enrollments.filter(f"enrolled_at {half} timestamp_ntz'1999-01-01'").withColumn(
            "enrolled_at", F.date_format("enrolled_at", "yyyy-MM-dd HH:mm:ss")
        ).write.option("header", True).csv(f"{root}/raw/enrollments/{date}")
    columns = [
        {"name": n, "type": "timestamp" if n == "enrolled_at" else "varchar(64)"}
        for n in enrollments.columns
    ]
    spec = load_registry(
        {
            "defaults": {"root_prefix": "raw", "copy_options": ["TIMEFORMAT 'auto'"]},
            "datasets": {"enrollments": {"columns": columns}},
        },
        base_uri=root,
    )["enrollments"]
    for _ in range(2):
        stream_land(spark, spec, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


_WINDOWS = """(SELECT time_bucket(INTERVAL 300 SECOND, ts) AS window_start,
  time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND AS window_end, event_type,
  count(*) AS observed FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1)"""

_MERGED_EVENTS = """SELECT * REPLACE (CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END
    AS value),
  CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS version,
  CAST(ts AS DATE) AS event_date FROM events"""

QUERIES = {
    "window_threshold_alert": (window_threshold_alert, f"SELECT * FROM {_WINDOWS}"),
    "window_maximum_alert": (
        window_maximum_alert,
        f"""SELECT time_bucket(INTERVAL 300 SECOND, ts) AS window_start,
          time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND AS window_end, event_type,
          max(value) AS observed FROM events GROUP BY 1, 2, 3 HAVING max(value) > {THRESHOLD}""",
    ),
    "stream_window_alert": (
        stream_window_alert,
        f"""SELECT * FROM {_WINDOWS} WHERE window_end <=
          (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)""",
    ),
    "stream_dedup": (stream_dedup_events, "SELECT * FROM events"),
    "stream_merge": (stream_merge_events, _MERGED_EVENTS),
    "stream_merge_published": (stream_merge_published, _MERGED_EVENTS),
    "stream_land": (
        stream_land_files,
        f"""SELECT *, CASE WHEN enrolled_at < TIMESTAMP '1999-01-01' THEN DATE '2024-03-01'
          ELSE DATE '2024-03-02' END AS load_date FROM {ENROLLMENTS}""",
    ),
}
