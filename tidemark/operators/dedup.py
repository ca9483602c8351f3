"""Exact copies, rows that share a key, and keys whose rows disagree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_exact(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct value of ``cols``. Copies meet on the map side first,
    so a group of copies of any size sends one row per task."""
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def keep_best(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[Column | str],
    row_id: str | None = None,
) -> DataFrame:
    """The first row of each key in the given order, which must be total.

    ``row_number() = 1`` is planned with a group limit ahead of the shuffle:
    each task sends at most one row per key, however many rows a key has.

    Rows without a key are no copies of each other and are all kept; with a
    ``row_id`` that happens in the same pass over the data.
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = _any_null(keys)
    if row_id is None:
        kept = _first(df.filter(~missing), [F.col(k) for k in keys], order)
        return kept.unionByName(df.filter(missing))
    return _first(df, [*map(F.col, keys), F.when(missing, F.col(row_id))], order)


def _first(df: DataFrame, by: list[Column], order) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def _any_null(keys: list[str]) -> Column:
    missing = F.col(keys[0]).isNull()
    for k in keys[1:]:
        missing = missing | F.col(k).isNull()
    return missing


def resolve_near(
    df: DataFrame,
    key: str | Sequence[str],
    position: str | Sequence[str] = "pos",
    valid: Column | None = None,
    row_id: str | None = None,
    prefer: str = "valid_then_first",
    revised: Column | None = None,
) -> DataFrame:
    """Settle rows that share a key but not their values.

    ``valid_then_first`` takes valid rows before invalid ones, then the lowest
    position, since originals come before their copies. ``revised_wins`` puts
    rows for which ``revised`` holds ahead of the position.
    """
    order = [F.col(p) for p in ([position] if isinstance(position, str) else position)]
    if prefer == "revised_wins":
        if revised is None:
            raise ValueError("revised_wins needs the 'revised' condition")
        order = [revised.desc(), *order]
    elif prefer != "valid_then_first":
        raise ValueError(f"unknown preference {prefer!r}")
    if valid is not None:
        order = [valid.desc(), *order]
    return keep_best(df, key, order, row_id)


def surplus(df: DataFrame, kept: DataFrame, row_id: str | Sequence[str], few: bool = False) -> DataFrame:
    """The rows of ``df`` that are not in ``kept``.

    Joined on the row identifier, which is unique, and not on the key: a key
    with very many copies is spread like any other rows.

    ``few`` is for callers who know that there are few of them, in a table that is cheap
    to read again: then only identifiers are shuffled, and those found are sent to every task.
    """
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    if few:
        found = df.select(*ids).join(kept.select(*ids), ids, "left_anti")
        return df.join(F.broadcast(found), ids, "left_semi")
    return df.join(kept.select(*ids), ids, "left_anti")


def conflict_report(
    df: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Keys whose rows differ, with the names of the columns that differ.

    A NULL beside a value counts as a difference. Rows without a key are no copies of
    each other and take no part. Columns are compared by 64-bit hashes, of which the
    smallest, the largest and the count are combined per task: no text is moved, and
    nothing is sorted, expanded or collected.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = list(columns or [c for c in df.columns if c not in keys])
    hashed = df.dropna(subset=keys).select(
        *keys, *[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(f"_h{i}") for i, c in enumerate(columns)]
    )
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    differing = []
    for i, c in enumerate(columns):
        h = f"_h{i}"
        aggs += [F.min(h).alias(f"_low{i}"), F.max(h).alias(f"_high{i}"), F.count(h).alias(f"_count{i}")]
        some = (F.col(f"_count{i}") > 0) & (F.col(f"_count{i}") < F.col("n_rows"))
        differing.append(F.when((F.col(f"_low{i}") != F.col(f"_high{i}")) | some, F.lit(c)))
    return (
        hashed.groupBy(*keys)
        .agg(*aggs)
        .filter("n_rows > 1")
        .select(*keys, "n_rows", F.array_compact(F.array(*differing)).alias("differing"))
        .filter(F.size("differing") > 0)
    )
