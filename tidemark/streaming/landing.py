"""Landing dated folders as they fill, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import write_through
from tidemark.sinks.versions import VersionedTable
from tidemark.sources.files import FAULTS, apply_load_options, csv_options, path_columns, variant_payload, with_bad
from tidemark.sources.registry import DatasetSpec

_DATE = r"/(\d{4}-\d{2}-\d{2})/[^/]*$"


def stream_dated(
    spark: SparkSession,
    spec: DatasetSpec,
    strict: bool = True,
    max_files: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """All dated folders of a dataset as a stream; ``load_date`` comes from the folder.

    As in a batch load, what does not fit its type or format stops a strict stream.
    Without ``strict`` such a value becomes NULL, and such a line is left out.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = f"{spec.path.rstrip('/')}/*/"
    load_date = F.regexp_extract(F.col("_metadata.file_path"), _DATE, 1)
    dated = F.nullif(load_date, F.lit("")).try_cast("date").alias("load_date")
    schema = schema or spec.schema
    if schema is None:
        raise ValueError(f"a stream of {spec.name!r} needs declared columns")
    if spec.format == "parquet":
        return reader.schema(schema).parquet(path).select("*", dated)
    whole = spec.format == "json" and [f.dataType for f in schema] == [T.VariantType()]
    if whole:
        name = schema.fieldNames()[0]
        lines = _readable(reader.text(path), spec, strict)
        return lines.select(variant_payload("value", name).alias(name), dated)
    if spec.format == "json" and spec.jsonpaths:
        raw = _readable(reader.text(path), spec, strict).select(*path_columns(spark, spec), dated)
    else:
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
        reader = reader.schema(text).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
        if spec.format == "csv":
            reader = reader.options(**csv_options(spec), enforceSchema=True)
        raw = reader.format(spec.format).load(path).select("*", dated)
    return apply_load_options(raw, spec, strict, keep=("load_date",))


def _readable(lines: DataFrame, spec: DatasetSpec, strict: bool) -> DataFrame:
    lines = lines.filter(F.trim("value") != "")
    whole = F.try_parse_json("value").isNotNull()
    if strict:
        message = F.concat(F.lit(f"{spec.name}: cannot read the line "), F.col("value"))
        whole = F.when(~whole, F.raise_error(message).cast("boolean")).otherwise(True)
    return lines.filter(whole)


def stream_land(
    spark: SparkSession,
    spec: DatasetSpec,
    out: str,
    checkpoint: str,
    strict: bool = True,
    max_files: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append new files to a Parquet folder by load date. The checkpoint remembers
    what was landed, so starting again does not double any rows."""
    return (
        stream_dated(spark, spec, strict, max_files)
        .writeStream.format("parquet")
        .partitionBy("load_date")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


REJECTS = T.StructType(
    [T.StructField("load_date", T.DateType()), *[T.StructField(n, T.StringType()) for n in ("reason", "line", "file")]]
)
_LINE, _FILE, _FAULTY = "_bad_line", "_file", "_text"


def stream_land_rejects(
    spark: SparkSession,
    spec: DatasetSpec,
    root: str,
    checkpoint: str,
    max_files: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Land new files in ``<root>/rows``, and what does not fit in ``<root>/rejects``.

    Both are versioned tables by load date; the rows of a batch are gathered by date. A
    line that does not fit the format is rejected as it is, with the reason ``format``; a
    row with values that do not fit their types as JSON text, with ``types`` and the
    columns. So every line is in one of the two. A batch that is replayed after a failure
    changes neither table: each remembers the last batch it has taken.
    """
    if spec.schema is None or spec.format == "parquet":
        raise ValueError(f"a stream of {spec.name!r} needs declared columns, as CSV or JSON")
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream
    file = F.col("_metadata.file_path")
    dated = F.nullif(F.regexp_extract(file, _DATE, 1), F.lit("")).try_cast("date").alias("load_date")
    lines = with_bad(reader, spec, f"{spec.path.rstrip('/')}/*/").select("*", dated, file.alias(_FILE))
    whole = [f.dataType for f in spec.schema] == [T.VariantType()] and not spec.jsonpaths
    keep = ("load_date", _FILE, _LINE, _FAULTY)
    rows, rejects = VersionedTable(spark, f"{root}/rows"), VersionedTable(spark, f"{root}/rejects")
    rows.create(T.StructType([*spec.schema, T.StructField("load_date", T.DateType())]), "load_date")
    rejects.create(REJECTS, "load_date")

    def land(batch: DataFrame, number: int) -> None:
        if whole:
            name = spec.schema.fieldNames()[0]
            bound = batch.select(variant_payload("value", name).alias(name), *keep[:3])
            loaded = bound.withColumns({FAULTS: F.array().cast("array<string>"), _FAULTY: F.lit("")})
        else:
            fields = path_columns(spark, spec) if spec.jsonpaths else [F.col(n) for n in spec.schema.fieldNames()]
            bound = batch.select(*fields, *keep[:3])
            bound = bound.withColumn(_FAULTY, F.to_json(F.struct(*spec.schema.fieldNames())))
            loaded = apply_load_options(bound, spec, strict=False, keep=keep, faults=FAULTS)
        # Read and parsed once, for both tables.
        loaded = write_through(loaded, "landing")
        fits = F.col(_LINE).isNull() & (F.size(FAULTS) == 0)
        reason = F.when(F.col(_LINE).isNotNull(), "format").otherwise(
            F.concat(F.lit("types: "), F.array_join(FAULTS, ", "))
        )
        bad = loaded.filter(~fits).select(
            "load_date", reason.alias("reason"), F.coalesce(_LINE, _FAULTY).alias("line"), F.col(_FILE).alias("file")
        )
        rejects.append(bad, mark=(checkpoint, number))
        rows.append(loaded.filter(fits).drop(FAULTS, *keep[1:]), mark=(checkpoint, number))

    return (
        lines.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
