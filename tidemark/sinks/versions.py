"""Tables published by commit: what a table holds is what its newest manifest names.

A run writes new folders, and last of all one small manifest that lists the folders of
every partition. Readers resolve the newest manifest, so they see the table as it was
before the commit or after it, never in between and never missing. A failed run leaves
folders that no manifest names. The state lives in the files: a later session, or one
with another catalog, goes on where the last one stopped.

One writer at a time: of two that commit the same version the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import delete_insert, merge_upsert, newer_than_max
from tidemark.session import write_through

# Fixed value: what a partition without a value is called.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Holds the id of the run that wrote a folder; no column of a table may be called so.
RUN = "_run"
#: Positions in one bitmap, which is 4 KB.
BITMAP = 32768

_MERGES = {"merge": merge_upsert, "delete+insert": delete_insert}


class CommitConflict(RuntimeError):
    """Another run has published the version that this one was about to."""


@dataclass(frozen=True)
class Manifest:
    """The folders of each partition, by the partition's value as text; '' in an unpartitioned table."""

    version: int
    schema: T.StructType
    partition_by: str | None
    parts: Mapping[str, tuple[str, ...]]
    #: Key columns, bitmaps a partition and bits a key of the key sketch; empty without one.
    sketch: Mapping = field(default_factory=dict)
    #: How far each writer has come, such as the last batch of a stream.
    marks: Mapping[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)
        found["schema"] = T.StructType.fromJson(found["schema"])
        found["parts"] = {k: tuple(v) for k, v in found["parts"].items()}
        return Manifest(**found)


class VersionedTable:
    """A table below ``root``; partitions are replaced or added to, one commit at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.data, self.sketches = f"{self.root}/data", f"{self.root}/sketches"

    # Reading

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest manifest, or that of a version; None before the first commit."""
        versions = self.versions()
        if version is None and not versions:
            return None
        return Manifest.of(_read_text(self.spark, self._manifest_path(versions[-1] if version is None else version)))

    def versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.root}/versions")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | Manifest | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The table as of a version or a manifest, the newest by default; only some partitions, given by their text."""
        now = version if isinstance(version, Manifest) else self.manifest(version)
        if now is None:
            raise FileNotFoundError(f"no version of a table has been published below {self.root}")
        names = now.parts if parts is None else [p for p in parts if p in now.parts]
        return self._open(now, [f for p in names for f in now.parts[p]])

    def read_last(self) -> DataFrame:
        """The rows of the partition with the largest value; all rows of an unpartitioned table."""
        now = self._current()
        names = [(p,) for p in now.parts if p != NO_VALUE]
        if now.partition_by is None or not names:
            return self.read(now)
        by_value = F.col("part").cast(now.schema[now.partition_by].dataType)
        return self.read(now, [self.spark.createDataFrame(names, "part string").orderBy(by_value.desc()).head()[0]])

    def _open(self, now: Manifest, folders: Sequence[str], *more: str) -> DataFrame:
        schema = T.StructType([*now.schema.fields, T.StructField(RUN, T.StringType())])
        if not folders:
            return self.spark.createDataFrame([], schema).select(*[f"`{c}`" for c in [*now.schema.names, *more]])
        reader = self.spark.read.schema(schema).option("basePath", self.data)
        rows = reader.parquet(*[f"{self.data}/{f}" for f in folders])
        return rows.select(*[f"`{c}`" for c in [*now.schema.names, *more]])

    # Publishing. Each method writes folders and publishes a manifest of them; with
    # ``publish=False`` it only returns the manifest, to be looked at and committed later.

    def commit(self, fresh: Manifest) -> Manifest:
        """Publish a manifest; fails if its version has been published since."""
        if not _write_text(self.spark, self._manifest_path(fresh.version), fresh.to_json()):
            raise CommitConflict(f"version {fresh.version} of {self.root} is there already")
        return fresh

    def replace(
        self,
        df: DataFrame,
        partition_by: str | None = None,
        key: str | Sequence[str] | None = None,
        bits_per_key: int = 32,
        publish: bool = True,
    ) -> Manifest:
        """``df`` as the whole table. With ``key``, merges find their partitions by a sketch of the keys."""
        now = self.manifest()
        written = self._write(df, partition_by)
        marks = {} if now is None else now.marks
        fresh = Manifest(1 if now is None else now.version + 1, df.schema, partition_by, written, marks=marks)
        if key is not None:
            if partition_by is None:
                raise ValueError("a key sketch is kept for the partitions of a table")
            fresh = self._sketched(fresh, [key] if isinstance(key, str) else list(key), bits_per_key)
        return self.commit(fresh) if publish else fresh

    def swap(self, df: DataFrame, parts: Iterable[str] = (), publish: bool = True) -> Manifest:
        """The rows of ``df`` in place of the partitions they belong to, and of those named in ``parts``.

        A partition in ``parts`` that gets no rows is gone. Columns new in ``df`` are
        added to the table; those it lacks are NULL.
        """
        gone = set(parts)
        return self._next(df, publish, lambda old, new: {**{p: f for p, f in old.items() if p not in gone}, **new})

    def append(
        self, df: DataFrame, dropping: Iterable[str] = (), mark: tuple[str, int] | None = None, publish: bool = True
    ) -> Manifest:
        """The rows of ``df`` beside those that are there, less the partitions ``dropping``. No file is rewritten.

        ``mark`` is a writer's name and a number that grows. It is published with the
        rows; an append that brings a mark already reached changes nothing.
        """
        now = self._current()
        if mark and now.marks.get(mark[0], -1) >= mark[1]:
            return now
        gone = set(dropping)

        def place(old: Mapping, new: Mapping) -> dict:
            kept = {p: f for p, f in old.items() if p not in gone}
            return {**kept, **{p: (*kept.get(p, ()), *f) for p, f in new.items()}}

        return self._next(df, publish, place, {mark[0]: mark[1]} if mark else {})

    def compact(self, most: int = 16) -> Manifest:
        """Partitions of more than ``most`` folders, as appends leave them, rewritten to one each."""
        now = self._current()
        many = [p for p, folders in now.parts.items() if len(folders) > most]
        if not many:
            return now
        if now.partition_by is None:
            return self.replace(self.read(now))
        return self.swap(self.read(now, many), many)

    def expire(self, keep: int) -> list[str]:
        """Delete the manifests before the last ``keep`` versions, and the folders that no other names.

        A run that is being written has folders that no manifest names yet: not to be called
        beside one. Readers of the versions that are kept are not disturbed.
        """
        if keep < 1:
            raise ValueError("the last version has to stay")
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        live = {f for m in kept for folders in m.parts.values() for f in folders}
        sketches = {x["folder"] for m in kept for x in m.sketch.get("files", ())}
        for v in versions[:-keep]:
            _delete(self.spark, self._manifest_path(v))
        gone = [f for f in _run_folders(self.spark, self.data) if f not in live]
        for f in gone:
            _delete(self.spark, f"{self.data}/{f}")
        for f in list_names(self.spark, self.sketches):
            if f not in sketches:
                _delete(self.spark, f"{self.sketches}/{f}")
        return gone

    def create(self, schema: T.StructType, partition_by: str | None = None) -> None:
        """An empty table, unless there is one."""
        if not self.exists():
            self.commit(Manifest(1, schema, partition_by, {}))

    def merge(self, source: DataFrame, key: str | Sequence[str], strategy: str = "merge", publish: bool = True) -> Manifest:
        """Merge the source by key; only partitions that the source or one of its keys is in are rewritten.

        Of a table with a sketch of the same key, only the partitions that the sketch
        names are read at all. A source with a repeated key fails under ``merge``.
        """
        now = self._current()
        keys = [key] if isinstance(key, str) else list(key)
        source = write_through(source, "merge-source")
        if now.partition_by is None:
            return self.replace(_MERGES[strategy](self.read(), source, keys), publish=publish)
        touched = self._partitions_of(source, now) | set(self.partitions_holding(source, keys))
        merged = _MERGES[strategy](self.read(parts=sorted(touched)), source, keys)
        return self.swap(merged, touched, publish)

    def partitions_holding(self, source: DataFrame, keys: Sequence[str]) -> list[str]:
        """The partitions, as text, that hold a row with a key of the source.

        The sketch names candidates from the source alone; the key columns of these,
        within the range of the source's keys, are then read to make sure.
        """
        now = self._current()
        wanted = source.select(*keys).dropna().distinct()
        names = self.candidates(wanted, keys) if list(now.sketch.get("keys", ())) == list(keys) else list(now.parts)
        if not names:
            return []
        first = F.col(keys[0])
        low, high = wanted.agg(F.min(first), F.max(first)).head()
        if low is None:
            return []
        held = self.read(parts=names).filter(first.between(F.lit(low), F.lit(high)))
        return self._values(held.join(wanted, list(keys), "left_semi"), now)

    def candidates(self, wanted: DataFrame, keys: Sequence[str]) -> list[str]:
        """The partitions whose sketch has all bits of a key, one or more, of the distinct keys ``wanted``.

        All partitions that hold a key are among them. Another one is named by a key with
        a chance of about 6 in a million, at 32 bits a key.
        """
        now = self._current()
        sketch = self._sketch_of(now)
        if sketch is None:
            return []
        block, bits = _places(keys, now.sketch["blocks"], now.sketch["probes"])
        probes = wanted.select(block.alias("block"), *[b.alias(f"bit{i}") for i, b in enumerate(bits)])
        hit = F.lit(True)
        for i in range(len(bits)):
            hit = hit & _has_bit(F.col("bitmap"), F.col(f"bit{i}"))
        # One short row for each folder named. Folders that have been replaced since count for nothing.
        named = sketch.join(probes, "block").filter(hit).select("part", "run").distinct().collect()
        runs = {p: {f.rpartition(f"{RUN}=")[2] for f in folders} for p, folders in now.parts.items()}
        return sorted({r.part for r in named if r.run in runs.get(r.part, ())})

    # Inside

    def _current(self) -> Manifest:
        now = self.manifest()
        if now is None:
            raise FileNotFoundError(f"no version of a table has been published below {self.root}")
        return now

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}.json"

    def _next(
        self, df: DataFrame, publish: bool, place: Callable[[Mapping, Mapping], Mapping], marks: Mapping[str, int] = {}
    ) -> Manifest:
        now = self._current()
        added = [f for f in df.schema.fields if f.name not in now.schema.names]
        schema = T.StructType([*now.schema.fields, *[T.StructField(f.name, f.dataType) for f in added]])
        written = self._write(_shaped(df, schema), now.partition_by)
        parts, marks = dict(place(now.parts, written)), {**now.marks, **marks}
        fresh = Manifest(now.version + 1, schema, now.partition_by, parts, now.sketch, marks)
        if now.sketch:
            fresh = self._sketched(fresh, now.sketch["keys"], now.sketch["bits_per_key"], now)
        return self.commit(fresh) if publish else fresh

    def _write(self, df: DataFrame, partition_by: str | None) -> dict[str, tuple[str, ...]]:
        run = uuid.uuid4().hex
        by = [partition_by] if partition_by else []
        # Gathered by partition, in parts of even size: or every task would write a file to every partition.
        rows = df.hint("rebalance", partition_by) if partition_by else df
        rows.withColumn(RUN, F.lit(run)).write.mode("append").partitionBy(*by, RUN).parquet(self.data)
        return _parts_written(self.spark, self.data, run, partition_by)

    def _values(self, df: DataFrame, now: Manifest) -> list[str]:
        # One short text for each partition.
        text = F.col(f"`{now.partition_by}`").cast("string")
        return [r[0] or NO_VALUE for r in df.select(text).distinct().collect()]

    def _partitions_of(self, source: DataFrame, now: Manifest) -> set[str]:
        if now.partition_by not in source.columns:
            return {NO_VALUE}
        return set(self._values(source, now))

    # Key sketches

    def _sketched(self, fresh: Manifest, keys: Sequence[str], bits_per_key: int, before: Manifest | None = None) -> Manifest:
        """``fresh`` with a sketch of its new folders. A folder's sketch is written once, beside its data."""
        known = {f for folders in (before.parts if before else {}).values() for f in folders}
        new = [f for folders in fresh.parts.values() for f in folders if f not in known]
        sketch = dict(fresh.sketch)
        text = F.coalesce(F.col(f"`{fresh.partition_by}`").cast("string"), F.lit(NO_VALUE))
        rows = self._open(fresh, new, RUN).select(*[f"`{k}`" for k in keys], text.alias("part"), F.col(RUN).alias("run"))
        rows = rows.dropna(subset=list(keys))
        if not sketch:
            largest = rows.groupBy("part").count().agg(F.max("count")).head()[0] or 0
            sketch = {"keys": list(keys), "bits_per_key": bits_per_key, "probes": max(1, bits_per_key // 4)}
            sketch["blocks"] = max(1, -(-largest * bits_per_key // BITMAP))
        if new:
            maps = _bitmaps(rows, keys, sketch["blocks"], sketch["probes"])
            folder = uuid.uuid4().hex
            maps.write.mode("errorifexists").parquet(f"{self.sketches}/{folder}")
            sketch["files"] = [*sketch.get("files", []), {"folder": folder, "folders": new}]
        live = {f for folders in fresh.parts.values() for f in folders}
        sketch["files"] = [x for x in sketch.get("files", []) if live & set(x["folders"])]
        return replace(fresh, sketch=sketch)

    def _sketch_of(self, now: Manifest) -> DataFrame | None:
        """(part, run, block, bitmap) of all folders that the manifest names, and of some it named before."""
        paths = [f"{self.sketches}/{x['folder']}" for x in now.sketch.get("files", ())]
        if not paths:
            return None
        return self.spark.read.schema("part string, run string, block int, bitmap binary").parquet(*paths)


def _places(keys: Sequence[str], blocks: int, probes: int) -> tuple[Column, list[Column]]:
    """Where a key stands in a sketch: its bitmap, and its positions in it."""
    columns = [F.col(f"`{k}`") for k in keys]
    block = F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")
    # Four positions of 15 bits from each hash.
    hashes = [F.xxhash64(*columns, F.lit(i)) for i in range(-(-probes // 4))]
    return block, [F.shiftrightunsigned(hashes[i // 4], 15 * (i % 4)).bitwiseAND(F.lit(BITMAP - 1)) for i in range(probes)]


def _bitmaps(rows: DataFrame, keys: Sequence[str], blocks: int, probes: int) -> DataFrame:
    """(part, run, block, bitmap) of the keys in ``rows``.

    The keys of a bitmap meet in parts of even size, one row a key, so that no task holds
    more than its part, however long the files are that it comes from. There is one bitmap
    for each probe at first, and then one of all.
    """
    block, bits = _places(keys, blocks, probes)
    by, names = ["part", "run", "block"], [f"bit{i}" for i in range(len(bits))]
    each = rows.select("part", "run", block.alias("block"), *[b.alias(n) for b, n in zip(bits, names)])
    each = each.hint("rebalance", *by).groupBy(*by).agg(*[F.bitmap_construct_agg(n).alias(n) for n in names])
    every = each.select(*by, F.explode(F.array(*names)).alias("bitmap"))
    return every.groupBy(*by).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _has_bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, position.bitwiseAND(F.lit(7)).cast("int")) == 1


def _shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = set(df.columns)
    extra = [f"`{c}`" for c in df.columns if c not in schema.names]
    columns = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*columns, *extra)


def incremental_version(
    source: DataFrame,
    root: str,
    key: str | Sequence[str],
    ts: str,
    strategy: str = "merge",
    partition_by: str | None = None,
    lookback: str | None = None,
    partition_follows_ts: bool = False,
    publish: bool = True,
) -> Manifest:
    """First run: the table. Later ones, in whatever session: the rows newer than its newest merged into it.

    ``partition_follows_ts`` says that the partition column grows with ``ts``; the newest
    row is then looked for in the last partition alone.
    """
    table = VersionedTable(source.sparkSession, root)
    now = table.manifest()
    if now is None:
        return table.replace(source, partition_by, key if partition_by else None, publish=publish)
    held = table.read_last() if partition_follows_ts else table.read(now)
    fresh = newer_than_max(source, held, ts, lookback=lookback)
    return table.merge(fresh, key, strategy, publish)


# Small files and listings by way of the cluster's file systems.


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    path, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _run_folders(spark: SparkSession, data: str) -> list[str]:
    """The folders of all runs, as manifests name them."""
    out = []
    for pattern, levels in ((f"{data}/{RUN}=*", 1), (f"{data}/*/{RUN}=*", 2)):
        path, fs = _path(spark, pattern)
        for found in fs.globStatus(path) or []:
            folder = found.getPath()
            name = folder.getName()
            out.append(name if levels == 1 else f"{folder.getParent().getName()}/{name}")
    return out


def move(spark: SparkSession, old: str, new: str) -> None:
    source, fs = _path(spark, old)
    target, _ = _path(spark, new)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise FileExistsError(f"cannot move {old} to {new}")


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file under its name at one moment; False if the name is taken."""
    p, fs = _path(spark, path)
    if fs.exists(p):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    return bool(fs.rename(draft, p))


def _parts_written(spark: SparkSession, data: str, run: str, partition_by: str | None) -> dict[str, tuple[str, ...]]:
    level = f"{partition_by}=*/" if partition_by else ""
    path, fs = _path(spark, f"{data}/{level}{RUN}={run}")
    out = {}
    for found in fs.globStatus(path) or []:
        folder = found.getPath()
        if partition_by is None:
            out[""] = (folder.getName(),)
        else:
            name = folder.getParent().getName()
            out[unquote(name.partition("=")[2])] = (f"{name}/{folder.getName()}",)
    return out
