"""Nested tag documents: four master records and nine arrays of child records each."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.contracts import KEY_ALIASES, MASTER_KEYS, TARGET_OF


def parse_tag_document(df: DataFrame, col: str = "data") -> DataFrame:
    """Add the parsed document as ``doc``; NULL where the text is no JSON object."""
    # Text of an object starts with a brace; anything else is not worth parsing.
    text = F.when(F.startswith(F.ltrim(F.col(col), F.lit(" \t\n\x0b\f\r")), F.lit("{")), F.col(col))
    return df.withColumn("doc", F.try_parse_json(text))


def malformed(parsed: DataFrame) -> DataFrame:
    """The envelopes of which something could not be read, with the reasons.

    ``malformed:data`` if the document is no JSON object; ``malformed:<key>`` if a list
    of child records is something else, or a master record is no object.
    """
    wrong = {key: _is_wrong(key) for key in sorted(TARGET_OF)}
    named = F.array_compact(F.array(*[F.when(broken, F.lit(f"malformed:{key}")) for key, broken in wrong.items()]))
    # The list of reasons is made for documents that have some. All others are only asked whether they do.
    reasons = F.when(F.col("doc").isNull(), F.array(F.lit("malformed:data"))).when(reduce(or_, wrong.values()), named)
    # A filter is not moved below the stack; below the parse it would parse every text a second and a third time.
    kept = [f"`{c}`" for c in parsed.columns if c not in ("doc", "reasons")]
    return parsed.select(*kept, F.stack(F.lit(1), reasons).alias("reasons")).filter(F.col("reasons").isNotNull())


def _is_wrong(key: str, doc: str = "doc") -> Column:
    """Whether there is something under a key that is neither null nor of the kind it has to be."""
    key = KEY_ALIASES.get(key, key)
    value = F.try_variant_get(doc, f"$.{key}", "variant")
    kind = "map<string,variant>" if key in MASTER_KEYS else "array<variant>"
    return F.try_variant_get(doc, f"$.{key}", kind).isNull() & value.isNotNull() & ~F.is_variant_null(value)


def records_of(key: str, doc: str = "doc") -> Column:
    """The records under a payload key as an array of VARIANT; a master record is one."""
    key = KEY_ALIASES.get(key, key)
    if key in MASTER_KEYS:
        value = F.try_variant_get(doc, f"$.{key}", "variant")
        return F.when(value.isNotNull() & ~F.is_variant_null(value), F.array(value))
    return F.try_variant_get(doc, f"$.{key}", "array<variant>")


def explode_child(parsed: DataFrame, key: str, keep: tuple[str, ...] = ("tag_id",)) -> DataFrame:
    """One row per record under ``key``; ``pos`` is its place in the array."""
    return parsed.select(*keep, F.posexplode(records_of(key)).alias("pos", "record"))


def explode_all(
    parsed: DataFrame,
    keep: tuple[str, ...] = ("tag_id",),
    keys: dict[str, str] | None = None,
) -> DataFrame:
    """All records of all keys in one pass over the documents, tagged with their table.

    One scan and one parse serve thirteen tables: write the result partitioned
    by ``table`` and each table reads back only its own folder.
    """
    keys = keys or TARGET_OF
    arrays = [pair for key, table in keys.items() for pair in (F.lit(table), records_of(key))]
    stacked = parsed.select(
        *keep, F.stack(F.lit(len(keys)), *arrays).alias("table", "records")
    )
    return stacked.select(*keep, "table", F.posexplode("records").alias("pos", "record"))


def child_record_counts(parsed: DataFrame, keep: tuple[str, ...] = ("tag_id",)) -> DataFrame:
    """Number of child records of each document, over its nine arrays."""
    sizes = [
        F.coalesce(F.array_size(records_of(key)), F.lit(0))
        for key in TARGET_OF
        if key not in MASTER_KEYS
    ]
    return parsed.select(*keep, sum(sizes[1:], sizes[0]).alias("child_records"))
