"""Quality of documents: boosted trees over statistics of the whole text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boosting, words
from tidemark.llm.sampling import bounded_sample
from tidemark.session import write_through

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:?",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+<=>@[\\]^_`{}~/",
    "quote": b"'\"()-",
    "line": b"\n",
    "high": bytes(range(128, 256)),
}
_CODE = np.zeros(256, dtype=np.uint8)
for _i, _members in enumerate(_CLASSES.values()):
    _CODE[list(_members)] = _i + 1
NAMES = (
    "log_bytes", "log_words", "word_length", "bytes_per_line", *(f"share_{c}" for c in _CLASSES),
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "ends_symbol", "ends_shout",
    "ends_stop", "starts_upper", "one_byte", "long_words", "run_of_words", "distinct_lines",
)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` for each text; 0 for shares of what an empty text lacks."""
    raw, offsets = words.text_bytes(texts)
    w = words.tokenize(texts)
    n = len(texts)
    size = np.diff(offsets).astype(float)
    count = np.diff(w.first).astype(float)

    def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        rows = np.flatnonzero(np.diff(first))
        if len(rows):
            out[rows] = np.add.reduceat(values, first[rows], dtype=np.int64)
        return out

    codes = _CODE[raw]
    per_byte = {c: per_row(codes == i + 1, offsets) for i, c in enumerate(_CLASSES)}
    lengths = w.ends - w.starts
    last, head = codes[w.ends - 1], codes[w.starts]
    is_ = {c: i + 1 for i, c in enumerate(_CLASSES)}
    same = np.zeros(len(w.hashes), dtype=bool)
    same[1:] = w.hashes[1:] == w.hashes[:-1]
    same[w.first[:-1][np.diff(w.first) > 0]] = False
    pairs = w.hashes.copy()
    pairs[1:] += w.hashes[:-1] * np.uint64(3)
    distinct, top, distinct_pairs, lines, runs = (np.zeros(n) for _ in range(5))
    breaks = np.flatnonzero(raw == 10)
    line_of = np.searchsorted(breaks, w.starts)
    for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
        if b == a:
            continue
        row = np.sort(w.hashes[a:b])
        edges = np.flatnonzero(np.r_[True, row[1:] != row[:-1], True])
        distinct[i], top[i] = len(edges) - 1, np.diff(edges).max()
        if b - a > 1:
            row = np.sort(pairs[a + 1 : b])
            distinct_pairs[i] = 1 + np.count_nonzero(row[1:] != row[:-1])
        still = np.flatnonzero(~same[a:b])
        runs[i] = np.diff(np.r_[still, b - a]).max()
        line = line_of[a:b]
        at = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        sums = np.add.reduceat(w.hashes[a:b], at)
        lines[i] = len(np.unique(sums)) / len(sums)
    some, many, bytes_ = np.maximum(count, 1), np.maximum(count - 1, 1), np.maximum(size, 1)
    word = lambda mask: per_row(mask, w.first) / some
    return np.stack(
        [
            np.log1p(size), np.log1p(count), per_row(lengths, w.first) / some,
            size / (per_byte["line"] + 1), *(v / bytes_ for v in per_byte.values()),
            distinct / some, top / some, word(same), distinct_pairs / many,
            word((last == is_["symbol"]) | (last == is_["bar"])), word(last == is_["shout"]),
            word(last == is_["stop"]), word(head == is_["upper"]), word(lengths == 1),
            word(lengths > 20), runs, lines,
        ],
        axis=1,
    ).astype(np.float32)


def document_statistics(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, x): the statistics of every row's whole text. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                x = statistics(part.column("text"))
                flat = pa.array(x.ravel(), pa.float32())
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], flat)
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "x"])

    slim = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return slim.mapInArrow(run, f"id {dict(slim.dtypes)['id']}, x array<float>")


def held_out(id: Column) -> Column:
    """Whether a document's label is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(
    stats: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 40_000, **options
) -> boosting.Trees:
    """Trees for ``label`` from rows that are not held out.

    At most ``most_rows`` labelled rows are used, chosen by a hash of their id: the bound
    of what the driver holds, and of what is sent to it. Rows with a null id or label teach nothing;
    a label other than 0 counts as 1.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isNotNull()
    )
    marked = write_through(stats.join(known, "id").filter(~held_out(F.col("id"))), "marked")
    sample = bounded_sample(marked, F.col("id"), most_rows).withColumn("h", F.xxhash64("id", "y", "x")).toPandas()
    # One order, whichever task sent a row first: the trees follow from the rows alone.
    sample = sample.sort_values(["h", "y"], ignore_index=True)
    x = np.stack(sample["x"]) if len(sample) else np.zeros((0, len(NAMES)))
    return boosting.fit(x, (sample["y"].to_numpy() != 0) if len(sample) else np.zeros(0), **options)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    text: str = "text",
    id: str = "doc_id",
    **options,
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    ``score`` is the probability of label 1, from the text alone; ``predicted`` is 1
    where it reaches ``threshold``. Null texts are scored as empty ones, repeated rows
    alike, a null id is not held out. Without usable labels every score is 0.5, with
    one class only near that class. Columns of other names are ignored.
    """
    stats = write_through(document_statistics(docs, text, id), "statistics")
    trees = fit_quality(stats, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), len(NAMES)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(trees.predict(x))], ["id", "score"])

    scored = stats.mapInArrow(run, f"id {dict(stats.dtypes)['id']}, score double")
    return scored.select(
        F.col("id").alias(id),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``; see ``score_documents``."""
    trees = fit_quality(write_through(document_statistics(docs, text, id), "statistics"), labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text):
                x = statistics(part.column(text)).astype(np.float64)
                yield part.filter(pa.array(trees.predict(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
