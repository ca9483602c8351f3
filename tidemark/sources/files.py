"""Scans of dated folders: CSV, JSON, Parquet, and whole JSON documents as VARIANT."""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import replace

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tidemark.functions import (
    auto_timestamp,
    blank_as_null,
    coerce_date,
    declared_timestamp,
    empty_as_null,
    truncate_bytes,
)
from tidemark.session import shared_dir
from tidemark.sources.registry import DatasetSpec

_BAD = "_bad_line"
#: The columns of a row whose text did not fit.
FAULTS = "_faults"


def resolve_load_date(explicit=None, run_conf: Mapping | None = None, logical_date=None) -> str:
    """The date to load: an explicit one, else the run's setting, else the logical date."""
    chosen = explicit or (run_conf or {}).get("load_date") or logical_date
    if not chosen:
        raise ValueError("no load date given")
    return str(chosen)


def read_dated(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    load_date: str,
    strict: bool = True,
) -> dict[str, DataFrame]:
    """Every dataset's folder for one date, with a ``load_date`` column.

    A required dataset without files is an error, an optional one is left out;
    nothing at all is an error.
    """
    found = {}
    for name, spec in specs.items():
        path = f"{spec.path.rstrip('/')}/{load_date}/"
        if has_files(spark, path):
            found[name] = read_dataset(spark, spec, path, strict).withColumn(
                "load_date", F.lit(load_date).cast("date")
            )
        elif spec.required:
            raise FileNotFoundError(f"required dataset {name!r} has no files under {path}")
    if not found:
        raise FileNotFoundError(f"no dataset has files for {load_date}")
    return found


def has_files(spark: SparkSession, path: str) -> bool:
    try:
        # Only the names are read: the file contents are pruned from the scan.
        return not spark.read.format("binaryFile").load(path).select("path").limit(1).isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


Paths = str | Sequence[str]


def read_dataset(
    spark: SparkSession, spec: DatasetSpec, path: Paths, strict: bool = True
) -> DataFrame:
    """Scan ``path``, or several files, as the spec says. With ``strict`` a value that does
    not fit its declared type, or a line that does not fit the format, fails the load.
    Without, such a value becomes NULL, and such a line is left out; ``rejected_lines`` has
    them. ``MAXERROR n`` leaves out up to ``n`` lines of a strict load, for either fault."""
    if spec.format == "csv":
        return read_csv(spark, spec, path, strict)
    if spec.format == "json":
        return read_json(spark, spec, path, strict)
    if spec.format == "parquet":
        return read_parquet(spark, spec, path)
    raise ValueError(f"unsupported format {spec.format!r}")


def csv_options(spec: DatasetSpec) -> dict:
    """Fields in double quotes may hold delimiters, doubled quotes and, if the dataset says
    ``multiline``, line breaks. Every field is parsed, so that a wrong number of them shows."""
    return {
        "sep": spec.delimiter,
        "header": spec.header,
        "quote": '"',
        "escape": '"',
        "multiLine": spec.multiline,
        "columnPruning": False,
    }


def read_csv(
    spark: SparkSession, spec: DatasetSpec, path: Paths, strict: bool = True
) -> DataFrame:
    """Columns bind by position; a header line is skipped, not matched."""
    spec, path = _unpacked(spark, spec, path)
    if spec.schema is None:
        mode = "FAILFAST" if strict else "DROPMALFORMED"
        return apply_load_options(
            spark.read.options(**csv_options(spec), mode=mode).csv(path), spec, strict
        )
    return _loaded(spark, spec, path, strict)


def with_bad(read: DataFrameReader | DataStreamReader, spec: DatasetSpec, path: Paths) -> DataFrame:
    """Declared columns as text, and the whole line where it does not fit the format.

    ``read`` is ``spark.read`` or ``spark.readStream``.
    """
    if spec.format == "json" and (spec.jsonpaths or _is_variant(spec)):
        broken = F.try_parse_json("value").isNull() & (F.trim("value") != "")
        lines = read.text(path)
        return lines.filter(F.trim("value") != "").select("value", F.when(broken, F.col("value")).alias(_BAD))
    fields = [
        f if isinstance(f.dataType, T.VariantType) and spec.format == "json" else T.StructField(f.name, T.StringType())
        for f in spec.schema
    ]
    # Scalars are read as text first: a typed field would turn "12.5" into NULL.
    schema = T.StructType([*fields, T.StructField(_BAD, T.StringType())])
    reader = read.schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD)
    if spec.format == "csv":
        return reader.options(**csv_options(spec), enforceSchema=True).csv(path)
    return reader.options(multiLine=spec.multiline).json(path)


def _is_variant(spec: DatasetSpec) -> bool:
    return spec.schema is not None and [f.dataType for f in spec.schema] == [T.VariantType()]


def rejected_lines(spark: SparkSession, spec: DatasetSpec, path: Paths) -> DataFrame:
    """(line, file): the lines of a CSV or JSON dataset that do not fit its format."""
    spec, path = _unpacked(spark, spec, path)
    rows = with_bad(spark.read, spec, path)
    return rows.filter(_broken(rows)).select(F.col(_BAD).alias("line"), F.col("_metadata.file_path").alias("file"))


def _broken(rows: DataFrame) -> Column:
    # Spark refuses to read the broken line alone, so another column takes part.
    other = F.coalesce(F.length(F.col(rows.columns[0]).cast("string")), F.lit(0)) >= 0
    return F.col(_BAD).isNotNull() & other


def _well_formed(spark: SparkSession, spec: DatasetSpec, path: Paths, strict: bool) -> DataFrame:
    rows = with_bad(spark.read, spec, path)
    message = F.concat(F.lit(f"{spec.name}: cannot read the line "), F.col(_BAD))
    whole = ~_broken(rows)
    if strict:
        whole = F.when(~whole, F.raise_error(message).cast("boolean")).otherwise(True)
    return rows.filter(whole).drop(_BAD)


def _loaded(spark: SparkSession, spec: DatasetSpec, path: Paths, strict: bool) -> DataFrame:
    """Typed rows. Under ``MAXERROR`` rows with either fault are counted and left out."""

    def bound(rows: DataFrame) -> DataFrame:
        return rows.select(*path_columns(spark, spec)) if spec.jsonpaths else rows

    if not (strict and spec.has_option("MAXERROR")):
        return apply_load_options(bound(_well_formed(spark, spec, path, strict)), spec, strict)
    most = int(spec.option("MAXERROR"))
    loaded = apply_load_options(bound(_well_formed(spark, spec, path, False)), spec, False, faults=FAULTS)
    found = rejected_lines(spark, replace(spec, compression="none"), path).limit(most + 1).count()
    if found <= most:
        found += loaded.filter(F.size(FAULTS) > 0).limit(most + 1).count()
    if found > most:
        raise ValueError(f"{spec.name!r} has more than {most} lines that do not fit its format or its types")
    return loaded.filter(F.size(FAULTS) == 0).drop(FAULTS)


def _unpacked(spark: SparkSession, spec: DatasetSpec, path: Paths) -> tuple[DatasetSpec, Paths]:
    """What to read in place of files that are declared gzip but not named so.

    Spark knows a codec by the file's name. Other files are unpacked, many at a time, to
    lines in the shared folder; a task holds one packed file and reads it as a stream. A
    file that cannot be unpacked fails the load with its name.
    """
    if spec.compression != "gzip":
        return spec, path
    packed = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    if packed.select("path").filter(~F.endswith("path", F.lit(".gz"))).isEmpty():
        return spec, path
    header = spec.header and spec.format == "csv"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rest, first = b"", True
                try:
                    with gzip.open(pa.input_stream(content.as_buffer())) as stream:
                        while chunk := stream.read(1 << 22):
                            *lines, rest = (rest + chunk).split(b"\n")
                            if first and lines and header:
                                lines, first = lines[1:], False
                            yield pa.RecordBatch.from_arrays([_as_text(lines)], ["value"])
                except (OSError, EOFError, zlib.error) as e:
                    raise ValueError(f"{spec.name!r}: cannot unpack {name}: {e}") from e
                if rest and not (first and header):
                    yield pa.RecordBatch.from_arrays([_as_text([rest])], ["value"])

    lines = packed.select("path", "content").mapInArrow(unpack, "value string")
    out = shared_dir(spark, "unpacked")
    lines.write.text(out)
    return replace(spec, compression="none", header=False), out


def _as_text(lines: list[bytes]) -> pa.Array:
    return pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())


def read_json(
    spark: SparkSession,
    spec: DatasetSpec,
    path: Paths,
    strict: bool = True,
    jsonpaths: list[str] | None = None,
) -> DataFrame:
    """Top-level keys bind by name, or a list of paths binds to the columns by position."""
    spec, path = _unpacked(spark, spec, path)
    if spec.schema is None:
        return spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    if jsonpaths:
        spec = replace(spec, jsonpaths=tuple(jsonpaths))
    names = spec.schema.fieldNames()
    if _is_variant(spec) and not spec.jsonpaths:
        lines = _well_formed(spark, spec, path, strict)
        return lines.select(variant_payload("value", names[0]).alias(names[0]))
    return _loaded(spark, spec, path, strict)


def path_columns(
    spark: SparkSession, spec: DatasetSpec, paths: str | Sequence[str] | None = None
) -> list[Column]:
    """The declared columns as paths into the line ``value``, bound by position.

    ``paths`` is a list, or the location of a document that holds one.
    """
    paths = paths or spec.jsonpaths
    if isinstance(paths, str):
        document = spark.read.text(paths, wholetext=True).head()[0]
        paths = json.loads(document)["jsonpaths"]
    names = spec.schema.fieldNames()
    if len(paths) != len(names):
        raise ValueError(f"{len(paths)} paths for {len(names)} columns of {spec.name!r}")
    return [F.get_json_object("value", p).alias(n) for n, p in zip(names, paths)]


def read_parquet(spark: SparkSession, spec: DatasetSpec, path: Paths) -> DataFrame:
    """Columns bind by the file's own schema, so filters and pruning reach the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_variant(spark: SparkSession, path: str, col: str = "payload") -> DataFrame:
    """One JSON document per line into one VARIANT column; NULL where a line is no JSON.

    A document that only wraps the payload under the column's own name is unwrapped.
    """
    return spark.read.text(path).select(variant_payload("value", col).alias(col))


def variant_payload(text: Column | str, col: str = "payload") -> Column:
    document = F.try_parse_json(text)
    return F.coalesce(F.try_variant_get(document, f"$.{col}", "variant"), document)


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines ``read_variant`` gives NULL for, with their file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.filter(F.try_parse_json("value").isNull())


def apply_load_options(
    df: DataFrame,
    spec: DatasetSpec,
    strict: bool = True,
    keep: tuple[str, ...] = (),
    faults: str | None = None,
) -> DataFrame:
    """Text columns to their declared types, with the dataset's load options applied.

    Columns in ``keep`` pass through. Text is cleaned first, then parsed, then checked:
    three projections, so that no step is repeated inside the next. ``faults`` names a
    column to be added with the names of the columns whose text did not fit.
    """
    fields = list(spec.schema or [f for f in df.schema if f.name not in keep])
    texts = df.select(*[_cleaned(F.col(f.name), f, spec).alias(f.name) for f in fields], *keep)
    typed = [f for f in fields if not isinstance(f.dataType, (T.StringType, T.VariantType))]
    places = {f.name: f"_value{i}" for i, f in enumerate(typed)}
    parsed = texts.withColumns({places[f.name]: _parsed(F.col(f.name), f, spec) for f in typed})
    loaded, wrong = [], []
    for f in fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            if f.metadata.get("length") and not spec.has_option("TRUNCATECOLUMNS"):
                wrong.append(F.when(F.octet_length(c) > f.metadata["length"], F.lit(f.name)))
            c = _fit(c, f, spec, strict)
        elif f.name in places:
            value = F.col(places[f.name])
            wrong.append(F.when(c.isNotNull() & value.isNull(), F.lit(f.name)))
            message = F.concat(F.lit(f"{spec.name}.{f.name}: cannot load "), c)
            c = F.when(c.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value) if strict else value
        loaded.append(c.alias(f.name))
    if faults:
        none = F.array().cast("array<string>")
        loaded.append((F.array_compact(F.array(*wrong)) if wrong else none).alias(faults))
    return parsed.select(*loaded, *keep)


def _cleaned(c: Column, field: T.StructField, spec: DatasetSpec) -> Column:
    if isinstance(field.dataType, T.VariantType):
        # A column read as VARIANT stays as it is; text is parsed.
        return F.try_parse_json(c) if spec.format == "csv" or spec.jsonpaths else c
    if spec.has_option("ACCEPTINVCHARS"):
        # Bytes that are no UTF-8 have become this character when the file was read.
        c = F.translate(c, "\ufffd", spec.option("ACCEPTINVCHARS") or "?")
    if spec.option("NULL") is not None:
        c = F.nullif(c, F.lit(spec.option("NULL")))
    if spec.has_option("BLANKSASNULL"):
        c = blank_as_null(c)
    if spec.has_option("EMPTYASNULL"):
        c = empty_as_null(c)
    return c


def _parsed(c: Column, field: T.StructField, spec: DatasetSpec) -> Column:
    if isinstance(field.dataType, T.TimestampNTZType) and spec.has_option("TIMEFORMAT"):
        layout = spec.option("TIMEFORMAT") or "auto"
        return auto_timestamp(c) if layout.lower() == "auto" else declared_timestamp(c, layout)
    if isinstance(field.dataType, T.DateType):
        layout = spec.option("DATEFORMAT") or "auto"
        return coerce_date(c) if layout.lower() == "auto" else declared_timestamp(c, layout).cast("date")
    return F.trim(c).try_cast(field.dataType)


def _fit(c: Column, field: T.StructField, spec: DatasetSpec, strict: bool) -> Column:
    length = field.metadata.get("length")
    if not length:
        return c
    if spec.has_option("TRUNCATECOLUMNS"):
        return truncate_bytes(c, length)
    too_long = F.octet_length(c) > length
    if not strict:
        return F.when(~too_long, c)
    message = F.concat(F.lit(f"{spec.name}.{field.name}: longer than {length} bytes: "), c)
    return F.when(too_long, F.raise_error(message)).otherwise(c)
