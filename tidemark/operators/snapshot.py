"""Type-2 history: every version of a row with the time it was valid."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.incremental import fail_if

# Names of the history columns.
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
UPDATED_AT = "dbt_updated_at"
SCD_ID = "dbt_scd_id"
META = (VALID_FROM, VALID_TO, UPDATED_AT, SCD_ID)


def snapshot(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str | None = None,
    strategy: str = "timestamp",
    check_cols: Sequence[str] | None = None,
    run_at: Column | str | None = None,
) -> DataFrame:
    """The history after one more look at the source, which has one row per key.

    ``timestamp``: a row whose ``updated_at`` is newer than its open version's
    gets a new version. ``check``: a row of which any column (or one of
    ``check_cols``) differs does, valid from ``run_at``. The old version is
    closed at that time. A key gone from the source stays open. A row without
    a key matches no version, so every run adds it anew.
    """
    if strategy == "timestamp":
        if updated_at is None:
            raise ValueError("the timestamp strategy needs updated_at")
        since = F.col(updated_at)
    elif strategy == "check":
        since = F.lit(run_at).cast("timestamp_ntz") if isinstance(run_at, str) else run_at
        since = F.localtimestamp() if since is None else since
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    fresh = source.select(
        "*",
        since.alias(VALID_FROM),
        F.lit(None).cast(source.select(since).schema[0].dataType).alias(VALID_TO),
        since.alias(UPDATED_AT),
        scd_id(key, since).alias(SCD_ID),
    )
    fresh = _one_per_key(fresh, key)
    if history is None:
        return fresh

    columns = [c for c in history.columns if c not in META]
    columns += [c for c in source.columns if c not in columns]
    history, fresh = _aligned(history, fresh, columns), _aligned(fresh, history, columns)
    # Closed versions never change, and rows without a key match nothing: both
    # stay out of the join.
    matchable = F.col(VALID_TO).isNull() & F.col(key).isNotNull()
    open_rows, settled_rows = history.filter(matchable), history.filter(~matchable)
    keyless = fresh.filter(F.col(key).isNull())
    fresh = fresh.filter(F.col(key).isNotNull())

    old, new = F.col("old"), F.col("new")
    if strategy == "timestamp":
        changed = new[VALID_FROM] > old[VALID_FROM]
    else:
        compared = list(check_cols or [c for c in columns if c != key])
        changed = ~reduce(lambda a, b: a & b, [old[c].eqNullSafe(new[c]) for c in compared])
    # One join settles both sides: a match that changed becomes two rows.
    both = open_rows.select(F.col(key).alias("_old_key"), F.struct("*").alias("old")).join(
        fresh.select(F.col(key).alias("_new_key"), F.struct("*").alias("new")),
        F.col("_old_key") == F.col("_new_key"),
        "full_outer",
    )
    is_new = old.isNull() | (new.isNotNull() & F.coalesce(changed, F.lit(False)))
    settled = F.when(
        is_new & new.isNotNull(), old.withField(VALID_TO, new[VALID_FROM])
    ).otherwise(old)
    versions = F.array_compact(
        F.array(F.when(old.isNotNull(), settled), F.when(is_new, new))
    )
    return settled_rows.unionByName(both.select(F.inline(versions))).unionByName(keyless)


def _one_per_key(fresh: DataFrame, key: str) -> DataFrame:
    """The rows as they are; a key that occurs twice fails the job.

    Keys are counted per task first, so a repeated key costs its count and not its rows.
    """
    counts = (
        fresh.dropna(subset=[key])
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(fail_if(F.col("_n") > 1, f"the source of a snapshot repeats a value of {key!r}"))
    )
    known = fresh.filter(F.col(key).isNotNull()).join(counts.select(key), key, "left_semi")
    return known.select(*fresh.columns).unionByName(fresh.filter(F.col(key).isNull()))


def scd_id(key: str, since: Column) -> Column:
    """Identifier of a version: md5 over its key and the time it is valid from."""
    return F.md5(
        F.concat_ws(
            "|",
            F.coalesce(F.col(key).cast("string"), F.lit("")),
            F.coalesce(since.cast("string"), F.lit("")),
        )
    )


def _aligned(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(
        *[
            F.col(c) if c in have else F.lit(None).cast(other.schema[c].dataType).alias(c)
            for c in columns
        ],
        *META,
    )


def validity_ranges(
    versions: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str] = (),
    grain: str = "day",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """All versions with the time each was followed by the next one of its key.

    A key's rows are spread over spans of time. Every span gets a mark at its
    end with the time of the first version after it, so that the next version
    is found within the span. Only the marks of a key meet each other: one row
    per span, however many versions it has.
    """
    spanned = versions.select(
        "*", F.date_trunc(grain, F.col(ts)).alias("_span"), F.lit(False).alias("_mark")
    )
    across = Window.partitionBy(key).orderBy("_span")
    marks = (
        spanned.groupBy(key, "_span")
        .agg(F.min(ts).alias(ts))
        .withColumns({ts: F.lead(ts).over(across), "_mark": F.lit(True)})
    )
    within = Window.partitionBy(key, "_span").orderBy("_mark", ts, *tiebreak)
    return (
        spanned.unionByName(marks, allowMissingColumns=True)
        .withColumn(valid_to, F.lead(ts).over(within))
        .filter(~F.col("_mark"))
        .select(*versions.columns, F.col(ts).alias(valid_from), valid_to)
    )
