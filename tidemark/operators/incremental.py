"""Incremental loads: high-water mark, merge by key, schema evolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1900-01-01"


def high_water_mark(df: DataFrame, ts: str, default: str = EPOCH) -> DataFrame:
    """The largest ``ts`` as one row and one column, the default if there is none."""
    kind = df.schema[ts].dataType
    return df.agg(F.coalesce(F.max(ts), F.lit(default).cast(kind)).alias(ts))


def newer_than_max(
    source: DataFrame,
    target: DataFrame | None,
    ts: str,
    default: str = EPOCH,
    lookback: str | None = None,
) -> DataFrame:
    """Source rows strictly newer than the newest of the target; all of them without one.

    The mark is a scalar subquery, so its value reaches the file scan as a
    pushed-down filter. ``lookback``, such as ``"2 hours"``, lowers the mark to
    take in late rows; use it with a merge, which makes reading twice harmless.
    """
    if target is None:
        return source
    mark = high_water_mark(target, ts, default)
    if lookback:
        mark = mark.select(F.col(ts) - F.expr(f"INTERVAL {lookback}"))
    return source.filter(F.col(ts) > mark.scalar())


def union_evolve(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; a column only one side has is NULL for the other."""
    return a.unionByName(b, allowMissingColumns=True)


def evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """The target with the source's new columns appended, NULL so far."""
    return union_evolve(target, source.limit(0))


def merge_upsert(target: DataFrame | None, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target rows replaced by the source rows of the same key, and new rows added.

    A key that occurs twice in the source fails the job. Only the target and
    the source's keys are shuffled; source rows go straight to the output.
    Without a target there is nothing to merge with: the source is the table.
    """
    if target is None:
        return source
    keys = _keys(key)
    unique = (
        source.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(fail_if(F.col("_n") > 1, f"the source of a merge repeats a key of {keys}"))
        .select(*keys)
    )
    return union_evolve(_not_in(target, unique, keys), source)


def delete_insert(
    target: DataFrame | None, source: DataFrame, key: str | Sequence[str]
) -> DataFrame:
    """Target rows with a key of the source removed, then all source rows added."""
    if target is None:
        return source
    keys = _keys(key)
    return union_evolve(
        _not_in(target, source.select(*keys).dropna().distinct(), keys), source
    )


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _not_in(target: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    # Rows without a key match nothing. Kept out of the join they cannot
    # gather in one partition of it.
    kept = target.dropna(subset=keys).join(keys_df, keys, "left_anti")
    return kept.select(*target.columns).unionByName(_null_keyed(target, keys))


def _null_keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    missing = F.col(keys[0]).isNull()
    for k in keys[1:]:
        missing = missing | F.col(k).isNull()
    return df.filter(missing)


def fail_if(condition: Column, message: str) -> Column:
    return F.when(condition, F.raise_error(F.lit(message)).cast("boolean")).otherwise(True)
