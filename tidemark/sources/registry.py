"""Dataset registry: which folders hold which tables, in what format and with what columns."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Formats a dataset may have.
FORMATS = ("csv", "json", "parquet")

# Load options, those that change what is loaded and those that only tune a warehouse.
LOAD_OPTIONS = (
    "TRUNCATECOLUMNS",
    "BLANKSASNULL",
    "EMPTYASNULL",
    "TIMEFORMAT",
    "DATEFORMAT",
    "NULL",
    "IGNOREBLANKLINES",
    "ACCEPTINVCHARS",
    "MAXERROR",
)
IGNORED_OPTIONS = ("COMPUPDATE", "STATUPDATE")
COMPRESSIONS = ("none", "gzip")

_OPTION = re.compile(r"^\s*([A-Za-z]+)(?:\s+AS)?(?:\s+(?:'((?:[^']|'')*)'|(\S+)))?\s*$", re.IGNORECASE)
_TYPE = re.compile(r"^\s*([a-z ]+?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$", re.IGNORECASE)
_PLAIN = {
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "super": T.VariantType(),
    "smallint": T.ShortType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "real": T.FloatType(),
    "float": T.DoubleType(),
    "double precision": T.DoubleType(),
    "boolean": T.BooleanType(),
    "text": T.StringType(),
}


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset after the defaults have been merged in."""

    name: str
    table: str
    path: str
    schema_name: str | None = None
    format: str = "csv"
    header: bool = True
    delimiter: str = ","
    compression: str = "none"
    multiline: bool = False
    jsonpaths: str | tuple[str, ...] | None = None
    required: bool = True
    load_options: tuple[str, ...] = ()
    columns: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType | None:
        return schema_from_registry(self.columns) if self.columns else None

    @property
    def qualified_table(self) -> str:
        return f"{self.schema_name}.{self.table}" if self.schema_name else self.table

    def has_option(self, name: str) -> bool:
        return any(parse_option(option)[0] == name for option in self.load_options)

    def option(self, name: str) -> str | None:
        """The value of a load option; of several the last, NULL without one."""
        values = [v for n, v in map(parse_option, self.load_options) if n == name]
        return values[-1] if values else None


def parse_option(option: str) -> tuple[str, str | None]:
    """``TIMEFORMAT AS 'auto'`` as its name in capitals and its value, if it has one."""
    match = _OPTION.match(option)
    if not match:
        raise ValueError(f"the load option {option!r} cannot be read")
    name, quoted, plain = match.groups()
    return name.upper(), quoted.replace("''", "'") if quoted is not None else plain


def load_registry(
    source: str | Mapping[str, Any],
    base_uri: str | None = None,
    spark: SparkSession | None = None,
) -> dict[str, DatasetSpec]:
    """Read a registry and merge its defaults into every dataset.

    ``source`` is a mapping or the path of a YAML or JSON file. With ``spark``
    the file is read through Spark, so it may lie in an object store.
    ``base_uri`` replaces the bucket as the root of the dataset folders.
    """
    registry = source if isinstance(source, Mapping) else _parse(_text(source, spark), source)
    if not registry or "datasets" not in registry:
        raise ValueError("the registry has no 'datasets' section")
    defaults = registry.get("defaults") or {}
    return {
        name: _spec(name, entry or {}, defaults, base_uri)
        for name, entry in (registry["datasets"] or {}).items()
    }


def schema_from_registry(columns) -> T.StructType:
    """Declared columns to a schema; declared text lengths go to the field metadata."""
    fields = []
    for column in columns:
        name, declared = (
            (column["name"], column["type"]) if isinstance(column, Mapping) else column
        )
        match = _TYPE.match(declared)
        base, length, scale = match.groups() if match else (None, None, None)
        base = re.sub(r"\s+", " ", base.lower()) if base else None
        metadata = {}
        if base in ("varchar", "char", "character varying"):
            kind = T.StringType()
            metadata = {"length": int(length)} if length else {}
        elif base in ("decimal", "numeric"):
            kind = T.DecimalType(int(length or 18), int(scale or 0))
        elif base in _PLAIN:
            kind = _PLAIN[base]
        else:
            raise ValueError(f"column {name!r} has the unknown type {declared!r}")
        fields.append(T.StructField(name, kind, True, metadata))
    return T.StructType(fields)


def _spec(name, entry, defaults, base_uri) -> DatasetSpec:
    def pick(key, otherwise=None):
        return entry.get(key, defaults.get(key, otherwise))

    kind = (pick("format") or "csv").lower()
    if kind not in FORMATS:
        raise ValueError(f"dataset {name!r} has the unsupported format {kind!r}")
    options = (*defaults.get("copy_options", ()), *entry.get("copy_options", ()))
    for option in options:
        if parse_option(option)[0] not in LOAD_OPTIONS + IGNORED_OPTIONS:
            raise ValueError(f"dataset {name!r} has the unknown load option {option!r}")
    compression = (pick("compression") or "none").lower()
    if compression not in COMPRESSIONS:
        raise ValueError(f"dataset {name!r} has the unknown compression {compression!r}")
    bucket = pick("s3_bucket")
    root = base_uri or (f"s3a://{bucket}" if bucket else "")
    below = entry.get("s3_prefix_base") or f"{(pick('root_prefix') or '').strip('/')}/{name}"
    paths = entry.get("jsonpaths") or entry.get("jsonpath")
    return DatasetSpec(
        name=name,
        table=entry.get("table", name),
        path="/".join(p for p in (root.rstrip("/"), below.strip("/")) if p),
        schema_name=pick("schema"),
        format=kind,
        header=bool(pick("header", True)),
        delimiter=pick("delimiter", ","),
        compression=compression,
        multiline=bool(pick("multiline", False)),
        jsonpaths=tuple(paths) if isinstance(paths, list) else paths,
        required=bool(pick("required", True)),
        load_options=options,
        columns=tuple((c["name"], c["type"]) for c in entry.get("columns") or ()),
    )


def _text(path: str, spark: SparkSession | None) -> str:
    if spark is not None:
        return spark.read.text(path, wholetext=True).head()[0]
    with open(path, encoding="utf-8") as f:
        return f.read()


def _parse(text: str, path: str) -> Any:
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ImportError("a YAML registry needs PyYAML; JSON files work without it") from e
    return yaml.safe_load(text)
