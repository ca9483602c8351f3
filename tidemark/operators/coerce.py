"""Loosely typed JSON records to typed columns, and the columns nobody expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce_date, coerce_timestamp, number_from_text, snake_name
from tidemark.operators.rules import (
    Rule,
    domain_rules,
    format_rules,
    range_rules,
    suffix_rules,
)
from tidemark.plans.contracts import DOMAINS, FORMATS, RANGES, REVISED, Contract

_TEXT = "_text"
#: Stands for the field names of a record that has none, because it is no object.
WHOLE = "(record)"


def record_texts(record: str | Column) -> Column:
    """All fields of a VARIANT record as text, whatever type each was sent as."""
    return F.try_variant_get(record, "$", "map<string,string>")


def coerce_table(df: DataFrame, contract: Contract, record: str = "record") -> DataFrame:
    """Replace the record by its contracted columns, typed; a value that cannot be read is NULL.

    Columns outside the contract go to ``_extra``. ``_text`` keeps the values
    as sent, so that a missing value can be told from an unreadable one. Of a record
    that is no object it keeps the JSON text, under ``(record)``.
    """
    # An envelope column with the same name as a field gives way to the field.
    kept = [c for c in df.columns if c != record and c not in contract.names]
    whole = F.create_map(F.lit(WHOLE), F.to_json(record))
    texts = df.select(*kept, F.coalesce(record_texts(record), whole).alias(_TEXT))
    return texts.select(
        *kept,
        *[_typed(F.col(_TEXT)[f.source], f.kind).alias(f.name) for f in contract.fields],
        extras(F.col(_TEXT), [*contract.sources, WHOLE]).alias("_extra"),
        _TEXT,
    )


def _typed(text: Column, kind: str) -> Column:
    if kind == "date":
        return coerce_date(text)
    if kind == "timestamp":
        return coerce_timestamp(text)
    if kind in ("double", "int"):
        return number_from_text(text, kind)
    return text


def contract_rules(contract: Contract) -> list[Rule]:
    """All rules of a table, for rows made by ``coerce_table``."""
    rules: list[Rule] = [("malformed:record", F.col(_TEXT)[WHOLE].isNotNull())]
    for f in contract.fields:
        sent = F.col(_TEXT)[f.source]
        rules.append((f"null:{f.name}", sent.isNull()))
        if f.length is None:
            rules.append((f"type:{f.name}", sent.isNotNull() & F.col(f.name).isNull()))
        else:
            rules.append((f"length:{f.name}", F.octet_length(f.name) > f.length))
    rules += domain_rules(DOMAINS.get(contract.table, {}))
    rules += format_rules(FORMATS.get(contract.table, {}))
    rules += range_rules(RANGES.get(contract.table, {}))
    ruled = {**DOMAINS.get(contract.table, {}), **FORMATS.get(contract.table, {})}
    free = [f.name for f in contract.fields if f.length is not None and f.name not in ruled]
    return rules + suffix_rules("revised", free, REVISED)


def extras(texts: Column, expected: list[str]) -> Column:
    """The fields of a record that the contract does not name; NULL if there are none."""
    found = F.map_filter(texts, lambda k, _: ~k.isin(*expected))
    return F.when(F.size(found) > 0, found)


def capture_extras(df: DataFrame, expected: list[str], record: str = "record") -> DataFrame:
    return df.withColumn("_extra", extras(record_texts(record), expected))


def extra_columns_profile(
    df: DataFrame,
    expected: list[str] | dict[str, list[str]],
    record: str = "record",
    table: str | Column | None = None,
) -> DataFrame:
    """How often each unexpected column occurs, by table.

    ``expected`` may differ by table: then it is a mapping and ``table`` a column.
    """
    keys = F.map_keys(record_texts(record))
    if isinstance(expected, dict):
        name = F.col(table) if isinstance(table, str) else table
        known = F.create_map(
            *[x for t, cols in expected.items() for x in (F.lit(t), F.array(*map(F.lit, cols)))]
        )
        unexpected = F.array_except(keys, known[name])
    else:
        name = F.lit(table or "records") if not isinstance(table, Column) else table
        unexpected = F.array_except(keys, F.array(*map(F.lit, expected)))
    return (
        df.select(name.alias("table"), F.explode(unexpected).alias("column"))
        .groupBy("table", "column")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def project_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Only the contracted columns."""
    return df.select(*contract.names)


def to_snake(df: DataFrame) -> DataFrame:
    """Rename PascalCase columns to snake_case."""
    return df.withColumnsRenamed({c: snake_name(c) for c in df.columns})
