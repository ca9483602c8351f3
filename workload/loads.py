"""Loads that are repeated, archives without a suffix, and what does not fit its format or its types."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.loads import load_registry_tables, table_of
from tidemark.session import shared_dir
from tidemark.sinks.versions import VersionedTable, list_names, move
from tidemark.sources import files
from tidemark.sources.registry import load_registry
from tidemark.streaming.landing import stream_land_rejects
from workload import inputs
from workload.inputs import ENROLLMENTS
from workload.loading import _ENROLLMENT_COLUMNS, OPTIONS

DATES = ("2024-03-01", "2024-03-02")
_EARLY = "enrolled_at < timestamp_ntz'1999-01-01'"
_BROKEN = "cast(enrollment_id as long) % 10"


def _specs(root: str, options=OPTIONS, **entry):
    registry = {"enrollments": {"columns": _ENROLLMENT_COLUMNS, "schema": "raw", "copy_options": options, **entry}}
    return load_registry({"defaults": {"root_prefix": "raw"}, "datasets": registry}, base_uri=root)


def _texts(spark, d):
    return inputs.enrollments(spark, d).withColumn("enrolled_at", F.date_format("enrolled_at", "yyyy-MM-dd HH:mm:ss"))


def registry_load(spark, d):
    """Two dates loaded into the registry's table, each twice; a file that came later is added."""
    root = shared_dir(spark, "registry-load")
    specs = _specs(root)
    rows = _texts(spark, d)
    for date, half in zip(DATES, (_EARLY, f"NOT {_EARLY}")):
        folder = f"{root}/raw/enrollments/{date}"
        half = rows.filter(F.expr(half.replace("enrolled_at", "cast(enrolled_at as timestamp_ntz)")))
        late = F.col("user_id").cast("long") % 3 == 0
        half.filter(~late).write.option("header", True).csv(folder)
        for _ in range(2):
            load_registry_tables(spark, specs, date, f"{root}/tables")
        half.filter(late).write.mode("append").option("header", True).csv(folder)
        for _ in range(2):
            load_registry_tables(spark, specs, date, f"{root}/tables")
    return table_of(spark, specs["enrollments"], f"{root}/tables").read().drop("_loaded_at", "_load_id")


def load_gzip_by_option(spark, d):
    """Archives whose names do not say so, unpacked because the dataset declares them."""
    root = shared_dir(spark, "gzip")
    folder = f"{root}/raw/enrollments/{DATES[0]}"
    _texts(spark, d).write.options(header=True, compression="gzip").csv(f"{root}/written")
    for i, name in enumerate(n for n in list_names(spark, f"{root}/written") if n.endswith(".gz")):
        move(spark, f"{root}/written/{name}", f"{folder}/part-{i}")
    return files.read_dated(spark, _specs(root, compression="gzip"), DATES[0])["enrollments"]


def _with_faults(spark, d):
    """CSV lines: of ten, one has a field too many and one a time that is none."""
    rows = _texts(spark, d).na.fill("")
    names = rows.columns
    kind = F.expr(_BROKEN)
    time = F.when(kind == 1, "no time").otherwise(F.col("enrolled_at"))
    line = F.concat_ws(",", *[time if n == "enrolled_at" else F.col(n) for n in names])
    return rows.select(F.when(kind == 0, F.concat(line, F.lit(",more"))).otherwise(line).alias("value"))


def load_maxerror(spark, d):
    """A strict load that leaves out the lines it may: too many fields, or a time that is none."""
    root = shared_dir(spark, "maxerror")
    _with_faults(spark, d).write.text(f"{root}/raw/enrollments/{DATES[0]}")
    specs = _specs(root, [*OPTIONS, "MAXERROR 1000000000"], header=False)
    return files.read_dated(spark, specs, DATES[0])["enrollments"]


def stream_land_rejected(spark, d):
    """The same lines landed by a stream: rows in one table, the rest with its reason in another."""
    root = shared_dir(spark, "land-rejects")
    _with_faults(spark, d).write.text(f"{root}/raw/enrollments/{DATES[0]}")
    spec = _specs(root, header=False)["enrollments"]
    for _ in range(2):
        stream_land_rejects(spark, spec, f"{root}/landed", f"{root}/checkpoint").awaitTermination()
    landed, rejects = (VersionedTable(spark, f"{root}/landed/{t}").read() for t in ("rows", "rejects"))
    return landed.select(F.lit("row").alias("what"), F.col("enrollment_id").alias("value")).unionByName(
        rejects.select(F.col("reason").alias("what"), F.regexp_extract("line", r"(\d+)", 1).alias("value"))
    )


_KIND = "CAST(enrollment_id AS BIGINT) % 10"

QUERIES = {
    "registry_load": (
        registry_load,
        f"""SELECT *, CASE WHEN enrolled_at < TIMESTAMP '1999-01-01' THEN DATE '2024-03-01'
          ELSE DATE '2024-03-02' END AS load_date FROM {ENROLLMENTS}""",
    ),
    "load_gzip_by_option": (load_gzip_by_option, f"SELECT *, DATE '2024-03-01' AS load_date FROM {ENROLLMENTS}"),
    "load_maxerror": (
        load_maxerror,
        f"SELECT *, DATE '2024-03-01' AS load_date FROM {ENROLLMENTS} WHERE {_KIND} > 1",
    ),
    "stream_land_rejects": (
        stream_land_rejected,
        f"""SELECT CASE {_KIND} WHEN 0 THEN 'format' WHEN 1 THEN 'types: enrolled_at' ELSE 'row' END AS what,
          enrollment_id AS value FROM {ENROLLMENTS}""",
    ),
}
