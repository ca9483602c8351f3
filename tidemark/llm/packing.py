"""Sharding by vector bin packing: bytes, words and rows of the shards are balanced jointly.

Rows of equal text form a group, which is placed as a whole; a group with more than
its fair part of a shard is first split into pieces. Each piece goes to the shard
where the dot product of its sizes with the shard's residual capacity is highest.

The few pieces that are large against a shard are placed first, in one bounded step.
All others are dealt into cells, each cell gets its part of what is left of every
shard, and the cells are packed independently of each other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import write_through

WORD = r"[^\x20\x09-\x0D]+"
#: A group or piece above this part of a shard, in any dimension, is split or placed first.
SPLIT_PARTS, LARGE_PARTS = 64, 256
DIMENSIONS = ("bytes", "words", "rows")


def place(sizes: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """The shard of each row of ``sizes``; ``residual`` (shards x dimensions) is used up.

    Sizes and residuals are parts of the whole, so the dimensions compare. Larger
    pieces go first. The highest dot product of size and residual wins; of equal ones
    the lowest shard.
    """
    order = np.argsort(-sizes.max(axis=1), kind="stable")
    out = np.empty(len(sizes), dtype=np.int32)
    for i in order:
        k = int(np.argmax(residual @ sizes[i]))
        out[i] = k
        residual[k] -= sizes[i]
    return out


def pack_shards(
    docs: DataFrame,
    shards: int = 8,
    text: str = "text",
    id: str = "doc_id",
    cell_pieces: int = 2048,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row; slots of a shard run from 0.

    Size is the bytes of the text plus 1. A null text counts as an empty one, both
    have size 1 and checksum 0. Rows that repeat, or share an id, are each placed. An
    id may be null. Other columns, whatever their names, are ignored. An empty table
    gives no rows. The same input in the same files gives the same result.

    A document larger than a shard's fair part still is placed whole.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = write_through(
        docs.select(F.col(f"`{id}`").alias("id"), body.alias("body")).select(
            "id",
            (F.octet_length("body") + 1).cast("long").alias("bytes"),
            F.regexp_count("body", F.lit(WORD)).cast("long").alias("words"),
            F.crc32(F.col("body").cast("binary")).alias("crc"),
            F.xxhash64("body").alias("group"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "packing-rows",
    )
    whole = base.agg(*[F.sum(c).alias(c) for c in ("bytes", "words")], F.count("*").alias("rows")).first()
    total = np.array([float(whole[d] or 0) for d in DIMENSIONS])
    scale = np.where(total > 0, total, 1.0)
    key = ["crc", "group", "bytes"]
    share = F.greatest(*[F.col(f"sum_{d}") / F.lit(float(s)) for d, s in zip(DIMENSIONS, scale)])
    # At most 3 * shards * SPLIT_PARTS groups can exceed the bound, so this side may be broadcast.
    hot = (
        base.groupBy(*key)
        .agg(
            F.sum("bytes").alias("sum_bytes"),
            F.sum("words").alias("sum_words"),
            F.count("*").alias("sum_rows"),
        )
        .filter((F.col("sum_rows") > 1) & (share * shards * SPLIT_PARTS > 1))
        .select(*key, F.ceil(share * shards * SPLIT_PARTS).cast("int").alias("parts"))
    )
    salted = base.join(F.broadcast(hot), key, "left").withColumn(
        "piece",
        F.coalesce(F.pmod(F.xxhash64(F.coalesce("id", "row")), F.col("parts")), F.lit(0)).cast("int"),
    )
    pkey = [*key, "piece"]
    pieces = write_through(
        salted.groupBy(*pkey).agg(
            F.sum("bytes").alias("sum_bytes"),
            F.sum("words").alias("sum_words"),
            F.count("*").alias("sum_rows"),
        ),
        "packing-pieces",
    )
    large = share * shards * LARGE_PARTS > 1
    first = pieces.filter(large).orderBy(*pkey).toPandas()  # 3 * shards * LARGE_PARTS rows at most
    columns = [f"sum_{d}" for d in DIMENSIONS]
    residual = np.tile(total / scale / shards, (shards, 1))
    first["shard"] = place(first[columns].to_numpy(dtype=float) / scale, residual)
    small = pieces.filter(~large)
    cells = max(1, -(-small.count() // cell_pieces))
    small = small.withColumn("cell", F.pmod(F.xxhash64(*pkey, F.lit("cell")), F.lit(cells)))
    left = residual.sum(axis=0)
    part = np.divide(residual, left, out=np.full_like(residual, 1 / shards), where=left > 1e-12)

    def pack_cell(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(pkey)
        sizes = cell[columns].to_numpy(dtype=float) / scale
        cell["shard"] = place(sizes, part * sizes.sum(axis=0))
        return cell[[*pkey, "shard"]]

    schema = "crc long, group long, bytes long, piece int, shard int"
    placed = small.groupBy("cell").applyInPandas(pack_cell, schema)
    if len(first):
        placed = placed.unionByName(spark.createDataFrame(first[[*pkey, "shard"]], schema))
    dealt = write_through(
        salted.join(placed, pkey).select("id", "row", "bytes", "crc", "shard"), "packing-shards"
    )
    return _with_slots(dealt, int(whole["rows"])).select(
        F.col("id").alias(id), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"), "shard", "slot"
    )


def _with_slots(dealt: DataFrame, rows: int) -> DataFrame:
    """Gapless slots: rows are numbered inside about sqrt(rows) buckets, buckets by running counts."""
    buckets = max(1, int(rows**0.5))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    starts = (
        dealt.groupBy("shard", "bucket")
        .agg(F.count("*").alias("held"))
        .select(
            "shard",
            "bucket",
            F.coalesce(
                F.sum("held").over(
                    Window.partitionBy("shard")
                    .orderBy("bucket")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("start"),
        )
    )
    place_in = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "row"))
    return (
        dealt.withColumn("place", place_in)
        .join(starts, ["shard", "bucket"])
        .withColumn("slot", (F.col("start") + F.col("place") - 1).cast("long"))
    )
