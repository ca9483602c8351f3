"""Source divergence audit: how the sources of a language differ in their words.

Terms are counted by length-bucketed packing: a term of up to 8 bytes becomes one
uint64 word, of up to 16 bytes two; these are radix-sorted and their runs counted.
Longer terms are sorted as bytes, in buckets of similar length. Spark adds the counts of
the batches, keeps the terms that enough documents of a language hold, and compares the
smoothed shares of every source with its language and with the other sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.session import write_through

UNIT = 1_000_000_000
#: What is compared at once: pairs of TILE x TILE sources over about BLOCK terms.
TILE, BLOCK = 128, 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """A stable order by columns of uint64, the first one most significant: 16 bits at a time, the last ones first."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        for shift in range(0, 64, 16):
            digit = (column >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                # A stable argsort of 16-bit numbers is a counting pass.
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def pack(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> list[np.ndarray]:
    """Terms of up to ``width`` bytes as columns of uint64, 8 bytes each, zeros behind. Terms hold no zero byte."""
    out = []
    for begin in range(0, width, 8):
        column = np.zeros(len(starts), dtype=np.uint64)
        for k in range(begin, begin + 8):
            has = np.flatnonzero(sizes > k)
            column[has] |= data[starts[has] + k].astype(np.uint64) << np.uint64(56 - 8 * (k - begin))
        out.append(column)
    return out


def term_runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(order, starts a new term) for each bucket of terms by length; ``order`` is stable among equal terms."""
    low = 0
    for width in (8, 16):
        at = np.flatnonzero((sizes > low) & (sizes <= width))
        low = width
        if len(at):
            columns = pack(data, starts[at], sizes[at], width)
            order = radix_order(columns)
            new = np.ones(len(at), dtype=bool)
            new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)
            yield at[order], new
    while low < (sizes.max() if len(sizes) else 0):
        at = np.flatnonzero((sizes > low) & (sizes <= 2 * low))
        low *= 2
        if len(at):
            terms = np.array([data[s : s + n].tobytes() for s, n in zip(starts[at], sizes[at])], dtype=f"S{low}")
            order = np.argsort(terms, kind="stable")
            new = np.ones(len(at), dtype=bool)
            new[1:] = terms[order[1:]] != terms[order[:-1]]
            yield at[order], new


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group of the batch.

    Every group has one more row with the term '', which no text holds, and zeros.
    """
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = langs.indices.to_numpy().astype(np.int64) * max(1, len(sources.dictionary)) + sources.indices.to_numpy()
    by_group = np.argsort(group, kind="stable")
    group = group[by_group]
    raw, offsets = words.text_bytes(text.take(pa.array(by_group)))
    data, inside = _LOWER[raw], _LETTER[raw]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    # A term begins where its text does or behind what is no letter, and ends likewise.
    goes_on = inside[1:] & inside[:-1] & ~edge[1:-1]
    first_of, last_of = inside.copy(), inside.copy()
    first_of[1:] &= ~goes_on
    last_of[:-1] &= ~goes_on
    starts, ends = np.flatnonzero(first_of), np.flatnonzero(last_of) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    groups, first = np.unique(group, return_index=True)
    picked, counts, held = [], [], []
    for order, new in term_runs(data, starts, ends - starts):
        of, by = doc[order], group[doc[order]]
        # Equal terms stand in the order of their documents, hence of their groups.
        run = new.copy()
        run[1:] |= by[1:] != by[:-1]
        fresh = run.copy()
        fresh[1:] |= of[1:] != of[:-1]
        at = np.flatnonzero(run)
        picked.append(order[at])
        counts.append(np.diff(np.r_[at, len(order)]))
        held.append(np.add.reduceat(fresh.astype(np.int64), at))
    pick = np.concatenate(picked) if picked else np.zeros(0, dtype=np.int64)
    sizes = (ends - starts)[pick]
    flat = np.repeat(starts[pick] - np.r_[0, np.cumsum(sizes)[:-1]] if len(pick) else pick, sizes) + np.arange(sizes.sum())
    limits = np.r_[0, np.cumsum(sizes), np.full(len(groups), sizes.sum())].astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(
        len(limits) - 1, pa.py_buffer(limits.tobytes()), pa.py_buffer(data[flat].tobytes())
    ).cast(pa.string())
    where = pa.array(by_group[np.r_[doc[pick], first].astype(np.int64)])
    zeros = np.zeros(len(groups), dtype=np.int64)
    columns = [lang.take(where), source.take(where), terms]
    columns += [pa.array(np.concatenate([*c, zeros]).astype(np.int64)) for c in (counts, held)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs) over all documents, with a row for the term '' in every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", 1 << 23):
                yield count_terms(part.column("lang"), part.column("source"), part.column("text"))

    named = {"lang": lang, "source": source, "text": text}
    slim = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in named.items()])
    found = slim.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    # The batches of a task are added up before the shuffle, so a common term costs one row a task and group.
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column, prior: int) -> Column:
    """1 + floor(UNIT * (count + prior) / (total + prior * kept)), exact."""
    top = (count + prior).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return 1 + F.call_function("div", top, (total + prior * kept).cast("decimal(20,0)"))


def audit_sources(
    docs: DataFrame,
    least_docs: int = 30,
    prior: int = 5,
    top: int = 50,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source apart, and from whom.

    A language keeps the terms that at least ``least_docs`` of its documents hold. Part
    ``term`` lists the ``top`` kept terms whose share in a source exceeds that in its
    language most. Part ``pair`` lists every other source of the language by the summed
    difference of shares over all kept terms. Equal values rank by the item's bytes.

    Null text, lang and source count as ''. A source without terms still has its pairs.
    Repeated rows count each; an empty table gives no rows; texts are read whole.
    Columns of other names are ignored.
    """
    counts = write_through(term_counts(docs, text, lang, source), "term-counts")
    terms = counts.filter(F.col("term") != "")
    kept = (
        terms.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n")
    )
    kept = write_through(kept, "kept-terms")
    held = write_through(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "held-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    in_lang = Window.partitionBy("lang")
    groups = (
        counts.filter(F.col("term") == "")
        .select("lang", "source")
        .join(sums, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "v", "lang_total"])
        .withColumn("none", F.when(F.col("v") > 0, _share(zero, F.col("total"), F.col("v"), prior)).otherwise(zero))
        .withColumn("tile", F.floor((F.row_number().over(in_lang.orderBy("source")) - 1) / TILE).cast("int"))
        .withColumn("tiles", F.max("tile").over(in_lang) + 1)
        .withColumn("blocks", F.ceil(F.col("v") / BLOCK).cast("int"))
    )
    groups = write_through(groups, "groups")

    p = _share(F.col("n"), F.col("total"), F.col("v"), prior)
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("v"), prior)
    shares = held.join(groups, ["lang", "source"]).withColumn("p", p).withColumn("q", q)
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    part_terms = (
        shares.filter(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
    )
    here = groups.select("lang", "source", "none", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("none2"))
    part_pairs = (
        here.join(other, "lang")
        .filter(F.col("source") != F.col("item"))
        .join(_pair_excess(shares, groups), ["lang", "source", "item"], "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), "item",
            (F.col("v") * F.abs(F.col("none") - F.col("none2")) + F.coalesce("excess", zero)).alias("value"),
        )
        .withColumn("rank", F.row_number().over(best))
    )
    return part_terms.unionByName(part_pairs)


def _pair_excess(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, excess): by how much a pair's difference exceeds that of two sources without any term.

    Pairs are compared tile by tile over blocks of terms: a task holds the shares of
    2 * TILE sources in about BLOCK terms, however many there are of either.
    """
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    slim = shares.select("lang", "source", "tile", "tiles", "none", block.alias("block"), "term", "p")
    # Every source is in every block, with or without terms of it.
    marks = groups.filter(F.col("v") > 0).select(
        "lang", "source", "tile", "tiles", "none", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"),
    )
    dealt = slim.unionByName(marks).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select(
        "lang", "block", F.least("tile", "with").alias("a"), F.greatest("tile", "with").alias("b"),
        "tile", "source", "none", "term", "p",
    )

    def compare(unit: pd.DataFrame) -> pd.DataFrame:
        a, b = int(unit["a"].iloc[0]), int(unit["b"].iloc[0])
        names = unit[["source", "tile", "none"]].drop_duplicates("source").sort_values("source", ignore_index=True)
        row = pd.Series(names.index, index=names["source"])
        seen = unit[unit["term"].notna()]
        column, distinct = pd.factorize(seen["term"])
        p = np.repeat(names["none"].to_numpy(np.int64)[:, None], len(distinct), axis=1)
        p[row[seen["source"]].to_numpy(), column] = seen["p"].to_numpy(np.int64)
        none, tile, out = names["none"].to_numpy(np.int64), names["tile"].to_numpy(), []
        for i in np.flatnonzero(tile == a):
            others = np.flatnonzero(tile == b)
            others = others[others != i]
            excess = np.abs(p[others] - p[i]).sum(axis=1) - len(distinct) * np.abs(none[others] - none[i])
            out.append(pd.DataFrame({"source": names["source"][i], "item": names["source"][others], "excess": excess}))
            if a != b:
                out.append(out[-1].rename(columns={"source": "item", "item": "source"}))
        found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({"source": [], "item": [], "excess": []})
        return found.assign(lang=unit["lang"].iloc[0])[["lang", "source", "item", "excess"]]

    parts = dealt.groupBy("lang", "block", "a", "b").applyInPandas(
        compare, "lang string, source string, item string, excess long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("excess").alias("excess"))
