"""Target-distribution importance resampling: documents drawn by how like a target corpus their words are.

The texts of a batch are joined by sentinels, one regex pass finds all words, and
searchsorted over the documents' offsets masks n-grams that cross documents. Features
are counted in hashed buckets, for the corpus and for the target. A bucket's gain is a
log ratio of the two; a document's weight is the sum of its gains. Weights with Gumbel
noise, ordered, are a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.session import write_through

#: A byte that UTF-8 never uses. It stands behind every text and matches as a word of its own.
SENTINEL = b"\xff"
_WORDS = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff")
#: Documents are told apart by the logarithm of their score in steps of 1 / STEPS, at most 90 * STEPS values.
STEPS = 64


def features(texts: pa.Array, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, where each document's features begin, words of each document).

    Features are runs of 1 to ``most`` words, a document's runs of one length in order.
    Only A-Z are lower-cased, a null text is empty; the byte 0xFF, which UTF-8 lacks,
    counts as 0xFE.
    """
    parts = [t.replace(SENTINEL, b"\xfe") for t in pc.fill_null(texts, "").cast(pa.large_binary()).to_pylist()]
    found = _WORDS.findall((SENTINEL.join(parts) + SENTINEL).lower())
    ends = np.flatnonzero(np.fromiter(map(SENTINEL.__eq__, found), dtype=bool, count=len(found)))
    if not len(parts):
        return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # Offsets of the documents among the words proper, sentinels left out.
    offsets = np.r_[0, ends - np.arange(len(ends))]
    found = [w for w in found if w != SENTINEL]
    total = len(found)
    doc = np.searchsorted(offsets, np.arange(total), side="right") - 1
    crc = np.fromiter(map(zlib.crc32, found), dtype=np.int64, count=total)
    owners, hashes = [doc], [crc]
    for n in range(2, most + 1):
        # The checksum of "a b" goes on from that of "a".
        longer = map(zlib.crc32, found[n - 1 :], map(zlib.crc32, repeat(b" "), crc[: max(total - n + 1, 0)].tolist()))
        crc = np.fromiter(longer, dtype=np.int64, count=max(total - n + 1, 0))
        within = doc[: len(crc)] == doc[n - 1 : n - 1 + len(crc)]
        owners.append(doc[: len(crc)][within])
        hashes.append(crc[within])
    owner, bucket = np.concatenate(owners), np.concatenate(hashes) % buckets
    if most > 1:
        order = np.argsort(owner, kind="stable")
        owner, bucket = owner[order], bucket[order]
    return bucket, np.searchsorted(owner, np.arange(len(parts) + 1)), np.diff(offsets)


def hashed_features(docs: DataFrame, text: str, id: str, most: int, buckets: int) -> DataFrame:
    """(row, id, n_words, buckets, counts): a row for every document, and one for every task.

    A document's row has the buckets of its features. A task's row has ``counts`` only:
    how often each bucket occurs in all its documents. So the counts of the corpus come
    from the one pass over the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(buckets, dtype=np.int64), None
        names = ["id", "n_words", "buckets", "counts"]
        for batch in batches:
            kind = batch.column("id").type
            for part in words.slices(batch, "text"):
                bucket, first, n_words = features(part.column("text"), most, buckets)
                counts += np.bincount(bucket, minlength=buckets)
                lists = pa.ListArray.from_arrays(first.astype(np.int32), pa.array(bucket.astype(np.int32)))
                none = pa.nulls(len(part), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n_words), lists, none], names)
        if kind is not None:
            one = [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.array([counts.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(one, names)

    slim = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = f"id {dict(slim.dtypes)['id']}, n_words long, buckets array<int>, counts array<long>"
    found = slim.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    return write_through(found, "hashed-features")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs: ``buckets`` numbers, whatever the size of the corpus."""
    summed = (
        found.filter(F.col("counts").isNotNull())
        .select(F.posexplode("counts").alias("bucket", "n"))
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    out = np.zeros(buckets, dtype=np.int64)
    for r in summed.collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier a bucket is in the target, with one added to each count."""
    both = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratios = [float(t + 1) * both[0] / (float(s + 1) * both[1]) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def gumbel(id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise, from the first 32 bits of a digest of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    most: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    text: str = "text",
    id: str = "doc_id",
    target_text: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) for every row of ``docs``; undrawn rows have no rank.

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred are drawn,
    rounded down: those with the highest scores, ties to the smaller id, a null id last.
    Null and empty texts have no features and the weight 0. Repeated rows are drawn each
    on its own. With an empty target every bucket counts as one. An empty table gives no
    rows. Texts are processed whole; columns of other names are ignored.
    """
    spark = docs.sparkSession
    found = hashed_features(docs, text, id, most, buckets)
    wanted = hashed_features(target.withColumn("_none", F.lit(0)), target_text, "_none", most, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            first = np.asarray(lists.offsets)
            sums = np.r_[0, np.cumsum(gain[lists.values.to_numpy()[first[0] : first[-1]]])]
            first = first - first[0]
            out = [batch.column("row"), batch.column("id"), batch.column("n_words")]
            out += [pa.array(np.diff(first).astype(np.int64)), pa.array(sums[first[1:]] - sums[first[:-1]])]
            yield pa.RecordBatch.from_arrays(out, ["row", "id", "n_words", "n_features", "weight"])

    kind = dict(found.dtypes)["id"]
    weighed = found.filter(F.col("counts").isNull()).select("row", "id", "n_words", "buckets")
    scored = weighed.mapInArrow(weigh, f"row long, id {kind}, n_words long, n_features long, weight long")
    score = F.col("weight") + gumbel(F.col("id"), seed)
    step = F.floor(F.signum("score") * F.log1p(F.abs("score")) * STEPS)
    scored = write_through(scored.withColumn("score", score).withColumn("step", step), "scores")

    # Which step of the score holds the last row drawn: at most 90 * STEPS counts.
    fit = F.col("n_words") >= least_words
    held = {r.step: r.n for r in scored.filter(fit).groupBy("step").agg(F.count("*").alias("n")).collect()}
    draw = percent * sum(held.values()) // 100
    last, seen = None, 0
    for last in sorted(held, reverse=True):
        seen += held[last]
        if seen >= draw:
            break
    near = fit & (F.col("step") >= last) if draw else F.lit(False)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    # Only the rows of those steps are sorted, over ranges; the number a task gives its rows is their place in it.
    ranges = scored.filter(near).repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = write_through(ranges.withColumn("place", F.monotonically_increasing_id()), "ranges")
    part, place = F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1)
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy(part).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("start")
    )
    rank = F.col("start") + place + 1
    ranked = ranges.withColumn("part", part).join(starts, "part").withColumn("rank", F.when(rank <= draw, rank))
    rest = scored.filter(~near).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
