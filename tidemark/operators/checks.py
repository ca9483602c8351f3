"""Declared data tests: each finds the rows that break it, and passes when there are none."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_keys(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, all counted in one pass."""
    return failure_counts(df, [(c, F.col(c).isNull()) for c in cols], "column", "n_null")


def failure_counts(
    df: DataFrame, conditions: Sequence[tuple[str, Column]], name: str = "test", n: str = "failures"
) -> DataFrame:
    """How many rows meet each condition; one aggregation, one row per condition."""
    counts = df.agg(*[F.count_if(c).alias(f"_{i}") for i, (_, c) in enumerate(conditions)])
    pairs = [x for i, (label, _) in enumerate(conditions) for x in (F.lit(label), F.col(f"_{i}"))]
    return counts.select(F.stack(F.lit(len(conditions)), *pairs).alias(name, n))


def duplicates(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. NULL is no key."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.select(*keys).dropna(subset=keys).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose key has no parent. Rows without a key are not orphans.

    Both sides reach the join straight from their shuffle, so adaptive
    execution can split a hot child key, or broadcast a parent found small.
    """
    return child.filter(F.col(fk).isNotNull()).join(
        parent.select(F.col(pk).alias("_pk")), F.col(fk) == F.col("_pk"), "left_anti"
    )


def orphan_keys(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child keys without a parent and their number of rows.

    The child is counted per key before the join, so no key is hot in it.
    """
    keys = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(pk).alias("key")).distinct()
    return keys.join(known, "key", "left_anti")


Edge = tuple[str, str, str, str]


def _text(df: DataFrame, column: str, like: T.DataType | None = None) -> Column:
    """A key as text, so that keys of all types stand in one column; equal keys have equal text.

    ``like`` is the type of the key it is to be compared with.
    """
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    plain = c + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else c
    if like is None or like == kind:
        return plain.cast("string")
    return F.coalesce(plain.try_cast(like).cast("string"), plain.cast("string"))


def _entry(use: int, key: Column, parent: bool = False, when: Column | None = None) -> Column:
    """What a row says about one check, NULL if nothing: the key it has, and whether it makes the key known."""
    held = key.isNotNull() if when is None else when
    return F.when(held, F.struct(F.lit(use).alias("use"), key.alias("key"), F.lit(parent).alias("parent")))


def _stacked(tables: Mapping[str, DataFrame], entries: Mapping[str, list[Column]]) -> DataFrame:
    """(use, key, rows, known) of all checks of all tables; each table is read once.

    A row is exploded into its entries. They are counted per task before the shuffle, so
    a key that very many rows have costs one row a task.
    """
    parts = [tables[t].select(F.explode(F.array_compact(F.array(*of))).alias("x")).select("x.*") for t, of in entries.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("use", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.max("parent").alias("known")
    )


def _edge_entries(
    tables: Mapping[str, DataFrame],
    edges: Mapping[int, Edge],
    known: Mapping[str, Column],
    entries: dict[str, list[Column]],
) -> None:
    for use, (child, fk, parent, pk) in edges.items():
        kind = tables[parent].schema[pk].dataType
        entries[child].append(_entry(use, _text(tables[child], fk, kind)))
        key = _text(tables[parent], pk)
        held = key.isNotNull() & known[parent] if parent in known else None
        entries[parent].append(_entry(use, key, parent=True, when=held))


def _held_edges(tables: Mapping[str, DataFrame], edges: Sequence[Edge]) -> dict[int, Edge]:
    return {i: e for i, e in enumerate(edges) if e[0] in tables and e[2] in tables}


def fk_counts(
    tables: Mapping[str, DataFrame], edges: Sequence[Edge], known: Mapping[str, Column] | None = None
) -> DataFrame:
    """(use, key, rows, known): of every edge, how many child rows have a key and whether a parent has it.

    ``use`` is the edge's place in ``edges``. Edges of missing tables are left out.
    """
    entries: dict[str, list[Column]] = defaultdict(list)
    _edge_entries(tables, _held_edges(tables, edges), known or {}, entries)
    return _stacked(tables, entries)


def fk_report(
    tables: Mapping[str, DataFrame],
    edges: Sequence[Edge],
    known: Mapping[str, Column] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Per relationship: how many keys have no parent, and how many rows carry them.

    All edges are settled in one pass over each table and one aggregation. ``known``
    says, for a table, which of its rows count as parents; ``counts`` may bring the
    written result of ``fk_counts``.
    """
    held = _held_edges(tables, edges)
    counts = fk_counts(tables, edges, known) if counts is None else counts
    lost = (F.col("rows") > 0) & ~F.col("known")
    found = counts.groupBy("use").agg(
        F.count_if(lost).alias("orphan_keys"), F.sum(F.when(lost, F.col("rows")).otherwise(0)).alias("orphan_rows")
    )
    names = [(i, f"{c}.{fk}", f"{p}.{pk}") for i, (c, fk, p, pk) in held.items()]
    listed = counts.sparkSession.createDataFrame(names, "use int, child string, parent string")
    return listed.join(found, "use", "left").na.fill(0).select("child", "parent", "orphan_keys", "orphan_rows")


def lost_ancestors(
    tables: Mapping[str, DataFrame],
    edges: Sequence[Edge],
    counts: DataFrame,
    known: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(path, keys, rows): rows whose parent is there, but whose parent's own parent, or one further up, is not.

    ``path`` names the columns from the row to the missing table, such as
    ``measurement.tag_id -> tag.equipment_id -> equipment``. ``counts`` is the written
    result of ``fk_counts`` over the same edges, which must not form a ring. A level of
    the graph costs one pass over the tables that are both child and parent.
    """
    spark, held = counts.sparkSession, _held_edges(tables, edges)
    ends = spark.createDataFrame([(i, f"{c}.{fk} -> {p}") for i, (c, fk, p, _) in held.items()], "use int, path string")
    lost = counts.filter((F.col("rows") > 0) & ~F.col("known")).select("use", "key").join(ends, "use")
    above = set(held)
    out = spark.createDataFrame([], "path string, keys long, rows long")
    for _ in range(len({t for e in held.values() for t in (e[0], e[2])})):
        # Edges whose child table is the parent of another edge hand their lost keys down.
        steps = [(i, j) for i in above for j in held if held[j][2] == held[i][0]]
        if not steps:
            return out
        entries: dict[str, list[Column]] = defaultdict(list)
        for i, j in steps:
            (table, fk, parent, pk), down = held[i], held[j]
            kind = tables[parent].schema[pk].dataType
            entries[table].append(
                F.struct(
                    F.lit(i).alias("use"), _text(tables[table], fk, kind).alias("key"),
                    F.lit(j).alias("down"), _text(tables[table], down[3]).alias("below"),
                    F.lit(f"{down[0]}.{down[1]} -> ").alias("step"),
                )
            )
        there = {t: tables[t].filter((known or {}).get(t, F.lit(True))) for t in entries}
        rows = [there[t].select(F.explode(F.array(*of)).alias("x")).select("x.*") for t, of in entries.items()]
        links = reduce(DataFrame.unionByName, rows).filter(F.col("key").isNotNull() & F.col("below").isNotNull())
        fallen = links.join(lost, ["use", "key"]).select(
            F.col("down").alias("use"), F.col("below").alias("key"), F.concat("step", "path").alias("path")
        )
        lost = fallen.distinct()
        carried = lost.join(counts.filter("rows > 0").select("use", "key", "rows"), ["use", "key"])
        out = out.unionByName(
            carried.groupBy("path").agg(F.count(F.lit(1)).alias("keys"), F.sum("rows").alias("rows"))
        )
        above = {j for _, j in steps}
    raise ValueError("the relationships form a ring")


@dataclass(frozen=True)
class DataTest:
    """``kind`` is not_null, unique, relationships or predicate.

    A predicate is a condition, as Spark SQL, that the failing rows meet.
    """

    table: str
    kind: str
    column: str
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships({self.table}.{self.column} -> {self.parent}.{self.parent_column})"
        return f"{self.kind}({self.table}.{self.column})"


def failing_rows(tables: Mapping[str, DataFrame], test: DataTest) -> DataFrame:
    df = tables[test.table]
    if test.kind == "not_null":
        return null_keys(df, test.column)
    if test.kind == "unique":
        return duplicates(df, test.column)
    if test.kind == "relationships":
        return orphans(df, tables[test.parent], test.column, test.parent_column)
    if test.kind == "predicate":
        return df.filter(test.column)
    raise ValueError(f"unknown kind of test {test.kind!r}")


def run_tests(tables: Mapping[str, DataFrame], suite: Sequence[DataTest]) -> DataFrame:
    """One row per test: its number of failures and whether it passed.

    Every table is read once, whatever its tests and the tests of its children ask, and
    one aggregation settles them all. A unique test fails by the keys that repeat, a
    relationship by the rows without a parent, the others by rows. ``failing_rows`` shows
    what makes a test fail.
    """
    entries: dict[str, list[Column]] = defaultdict(list)
    for use, test in enumerate(suite):
        df = tables[test.table]
        if test.kind in ("not_null", "predicate"):
            failing = F.col(f"`{test.column}`").isNull() if test.kind == "not_null" else F.expr(test.column)
            entries[test.table].append(_entry(use, F.lit(""), when=failing))
        elif test.kind == "unique":
            entries[test.table].append(_entry(use, _text(df, test.column)))
        elif test.kind == "relationships":
            edge = (test.table, test.column, test.parent, test.parent_column)
            _edge_entries(tables, {use: edge}, {}, entries)
        else:
            raise ValueError(f"unknown kind of test {test.kind!r}")
    found = _stacked(tables, entries).groupBy("use").agg(
        F.count_if(F.col("rows") > 1).alias("unique"),
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("rows"))).alias("relationships"),
        F.sum("rows").alias("rows"),
    )
    listed = found.sparkSession.createDataFrame(
        [(i, t.name, t.kind) for i, t in enumerate(suite)], "use int, test string, kind string"
    )
    failures = (
        F.when(F.col("kind") == "unique", F.col("unique"))
        .when(F.col("kind") == "relationships", F.col("relationships"))
        .otherwise(F.col("rows"))
    )
    return listed.join(found, "use", "left").select(
        "test",
        F.coalesce(failures, F.lit(0)).alias("failures"),
        (F.coalesce(failures, F.lit(0)) == 0).alias("passed"),
    )
