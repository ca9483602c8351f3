"""Embedding near-duplicates: lattice hashing with neighbouring cells, cosines verified exactly.

Equal vectors of one label form a class. Each class has a home cell in every table and
some neighbouring cells; two classes meet where one's home is the other's home or
neighbour. Cells are cut into tiles of bounded size, and each tile is one product of two
small matrices. A tile counts the links of its vectors and reports a forest that spans
them, never the pairs themselves. A pair that meets more than once is counted at the
first meeting only, which both cell lists tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.lattice import Tables
from tidemark.llm.words import mix
from tidemark.session import write_through

#: Classes on each side of a tile.
TILE = 256


def _hashed(rows: list[bytes], labels: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), dtype=np.uint64)
    for i, (row, label) in enumerate(zip(rows, labels)):
        bits = np.frombuffer(row, dtype=np.uint64)
        places = np.arange(1, len(bits) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out[i] = mix(bits + places).sum(dtype=np.uint64) + np.uint64(len(bits))
    return mix(out ^ mix(labels.astype(np.int64).view(np.uint64))).view(np.int64)


def _prepared(slim: DataFrame, options: dict) -> DataFrame:
    """(row, id, cls, unit, homes, near): cls is null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Tables] = {}
        for batch in batches:
            n = len(batch)
            cls, unit, homes, near = ([None] * n for _ in range(4))
            by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
            labels = batch.column("label").to_pylist()
            vectors = batch.column("v")
            for i in range(n):
                if labels[i] is None or not vectors[i].is_valid:
                    continue
                values = vectors[i].values
                if not len(values) or values.null_count:
                    continue
                v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    v = v / np.abs(v).max() if np.isfinite(v).all() and v.any() else None
                if v is not None:
                    by_size.setdefault(len(v), []).append((i, v / np.sqrt(v @ v) + 0.0))
            for size, members in by_size.items():
                tables = known.setdefault(size, Tables(size, **options))
                rows = [i for i, _ in members]
                units = np.stack([v for _, v in members])
                h, c = tables.cells(units)
                raw = [u.tobytes() for u in units]
                ids = _hashed(raw, np.array([labels[i] for i in rows]))
                for k, i in enumerate(rows):
                    cls[i], unit[i], homes[i], near[i] = int(ids[k]), raw[k], h[k].tolist(), c[k].ravel().tolist()
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("id"), batch.column("label"), pa.array(cls, pa.int64()),
                    pa.array(unit, pa.binary()), pa.array(homes, longs), pa.array(near, longs),
                ],
                ["row", "id", "label", "cls", "unit", "homes", "near"],
            )

    kinds = dict(slim.dtypes)
    schema = f"row long, id {kinds['id']}, label long, cls long, unit binary, homes array<long>, near array<long>"
    return slim.mapInArrow(run, schema)


def _met_before(t: int, homes_a, near_a, homes_b, near_b) -> np.ndarray:
    """Whether pairs of classes met in a table before ``t``."""
    out = np.zeros(len(homes_a), dtype=bool)
    for k in range(t):
        a, b = homes_a[:, k], homes_b[:, k]
        out |= (a == b) | (near_a[:, k] == b[:, None]).any(axis=1) | (near_b[:, k] == a[:, None]).any(axis=1)
    return out


def _links(t: int, kind: int, cls, unit, homes, near, left, right, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a tile between rows ``left`` and ``right``. kind 0: homes with themselves, 1: two parts of homes, 2: neighbours with homes."""
    close = unit[left] @ unit[right].T >= cosine
    if kind == 0:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    i, j = left[i], right[j]
    if not len(i):
        return i, j
    good = (cls[i] != cls[j]) & ~_met_before(t, homes[i], near[i], homes[j], near[j])
    if kind == 2:  # if each is the other's neighbour, the smaller number asks
        mutual = (near[j, t] == homes[i, t][:, None]).any(axis=1)
        good &= ~mutual | (cls[i] < cls[j])
    return i[good], j[good]


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches cut anew so that every tile is in one piece."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        tile = table.column("tile").to_numpy()
        other = np.flatnonzero(tile != tile[-1]) if len(tile) else tile
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None and len(held):
        yield held.combine_chunks()


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that join what the others join already left out."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            kept.append((x, y))
    return kept


def _whole(df: DataFrame, column: str) -> Column:
    """A column as whole numbers with equal ones for equal values: itself, or a hash of 64 bits."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    return c.cast("long") if isinstance(kind, (T.IntegralType, T.NullType)) else F.when(c.isNotNull(), F.xxhash64(c))


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.98,
    tables: int = 8,
    blocks: int = 2,
    probes: int = 3,
    scale: float = 0.6,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Two rows are linked if their labels are equal and their cosine, in double precision,
    is at least ``cosine``. Rows whose label or vector is null, whose vector is empty or
    zero or holds a null or a number that is not finite, are linked with nothing, nor
    are vectors of different length. Equal vectors are linked; repeated rows are rows of
    their own. Labels may be of any type that has a hash. ``n_links`` counts the other rows, ``component_id`` is the smallest id
    reachable (null ids do not count), ``kept`` says whether it is the row's own. Columns
    of other names are ignored. An empty table gives no rows.

    Each table projects to ``8 * blocks`` dimensions, scaled by ``scale`` times the root
    of the dimension; per block ``probes`` neighbouring points are tried. Links found
    are exact; a pair close in no table is missed, which more tables make rarer.
    """
    options = {"tables": tables, "blocks": blocks, "probes": probes, "scale": scale}
    slim = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id}`").alias("id"),
        _whole(vectors, label).alias("label"),
        F.col(f"`{vector}`").alias("v"),
    )
    ready = write_through(_prepared(slim, options), "vectors")
    classes = write_through(
        ready.filter("cls IS NOT NULL")
        .groupBy("cls")
        .agg(
            F.count("*").alias("m"),
            *[F.first(c).alias(c) for c in ("label", "unit", "homes", "near")],
        ),
        "vector-classes",
    )
    width = blocks * probes
    classes = classes.withColumn("size", F.octet_length("unit"))
    at_home = classes.select("cls", "label", "size", F.posexplode("homes").alias("t", "cell"), F.lit(True).alias("home"))
    beside = classes.select("cls", "label", "size", F.posexplode("near").alias("k", "cell"), F.lit(False).alias("home")).select(
        "cls", "label", "size", F.floor(F.col("k") / width).cast("int").alias("t"), "cell", "home"
    )
    key = ["label", "size", "t", "cell"]
    places = at_home.unionByName(beside)
    full = (
        places.groupBy(*key)
        .agg(F.count_if("home").alias("nh"), F.count_if(~F.col("home")).alias("nn"))
        .filter("nh > 1 OR (nh > 0 AND nn > 0)")
        .select(
            *key,
            F.ceil(F.col("nh") / TILE).cast("int").alias("ph"),
            F.ceil(F.col("nn") / TILE).cast("int").alias("pn"),
        )
    )
    part = F.pmod(F.xxhash64("cls"), F.when(F.col("home"), F.col("ph")).otherwise(F.col("pn"))).cast("int")
    dealt = places.join(full, key).withColumn("part", part)
    # kind 0/1: home parts i <= j; kind 2: neighbour part i, home part j. side: left or right of the tile.
    tile = lambda kind, i, j, side: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side")
    )
    own = F.col("part")
    none = F.expr("cast(array() as array<struct<kind:int,i:int,j:int,side:int>>)")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    for_home = F.concat(
        F.array(tile(0, own, own, 0)),
        F.transform(F.filter(upto(F.col("ph")), lambda k: k > own), lambda k: tile(1, own, k, 0)),
        F.transform(F.filter(upto(F.col("ph")), lambda k: k < own), lambda k: tile(1, k, own, 1)),
        F.transform(upto(F.col("pn")), lambda k: tile(2, k, own, 1)),
    )
    for_near = F.transform(upto(F.col("ph")), lambda k: tile(2, own, k, 0))
    tiles = dealt.select(*key, "cls", F.inline(F.when(F.col("home"), for_home).otherwise(F.coalesce(for_near, none))))
    rows = (
        tiles.select(F.xxhash64(*key, "kind", "i", "j").alias("tile"), "t", "kind", "side", "cls")
        .join(classes.select("cls", "m", "unit", "homes", "near"), "cls")
        .repartition("tile")
        .sortWithinPartitions("tile")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            tile, ts, kinds, side, cls, m = (table.column(c).to_numpy() for c in ("tile", "t", "kind", "side", "cls", "m"))
            homes = table.column("homes").chunk(0).flatten().to_numpy().reshape(len(table), tables)
            near = table.column("near").chunk(0).flatten().to_numpy().reshape(len(table), tables, width)
            units = table.column("unit").chunk(0)
            edges = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1], True])
            out_a, out_b, out_n = [], [], []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                kind, one, two = int(kinds[lo]), side[lo:hi] == 0, side[lo:hi] == 1
                if kind == 0:
                    two = one
                if hi - lo < 2 or not one.any() or not two.any():
                    continue
                unit = np.stack([np.frombuffer(u.as_buffer(), dtype=np.float64) for u in units[lo:hi]])
                part = slice(lo, hi)
                i, j = _links(
                    int(ts[lo]), kind, cls[part], unit, homes[part], near[part],
                    np.flatnonzero(one), np.flatnonzero(two), cosine,
                )
                if not len(i):
                    continue
                links = np.bincount(i, m[part][j], hi - lo) + np.bincount(j, m[part][i], hi - lo)
                some = np.flatnonzero(links)
                joined = _forest(cls[part][i], cls[part][j])
                out_a += [*cls[part][some].tolist(), *(x for x, _ in joined)]
                out_b += [*[None] * len(some), *(y for _, y in joined)]
                out_n += [*links[some].astype(np.int64).tolist(), *[0] * len(joined)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (out_a, out_b, out_n)], ["a", "b", "n"])

    found = write_through(rows.mapInArrow(compare, "a long, b long, n long"), "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("b IS NOT NULL")).select(F.col("node").alias("cls"), F.col("component").alias("root"))
    whole = (
        classes.select("cls", "m")
        .join(counts, "cls", "left")
        .join(roots, "cls", "left")
        .select("cls", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    )
    placed = write_through(ready.select("row", "id", "cls").join(whole, "cls", "left"), "vector-places")
    # A table of its own, so that a root with very many rows is split when it is joined.
    least = write_through(placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least")), "least")
    out = placed.join(least, "root", "left").withColumn("component_id", F.coalesce("least", "id"))
    return out.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
