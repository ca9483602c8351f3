"""Benchmark decontamination: item-sized windows of documents that edits turn into a benchmark item.

The edit distance of word sequences is embedded into Hamming distance by a random walk
(CGK): at every step the word under the pointer is written out, and a random bit of the
step and the word says whether the pointer moves on. After an edit two walks fall in step
again soon, so windows a few edits apart agree at most steps. Each table is a walk of its
own from a place inside the item, and samples a few of its steps; a window is a candidate
if it has the item's words there. The places of successive tables are spread over the
whole item, so edits in one part of it spare the tables of the others.

Tables are added until a lower confidence bound of the rate at which edited items are
found reaches the target: for items of each length, for scattered edits, and for blocks of
edits at the start, the middle and the end. Items for which that is not reached are
searched for exactly: of k + 1 segments of an item k edits leave one unchanged, so every
window with a segment is a candidate. All candidates are verified by the exact edit
distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words

#: Walks reach over about this many words of an item, less in short items.
SPANS = (8, 4, 2, 1)
#: Steps that a table samples of its walk.
SAMPLED = 3
MOST_TABLES = 40
#: Items of lengths that differ by less are judged together.
BAND = 8
#: Edited items of each kind that a rate is judged by, and the risk that the bound is wrong.
DRAWS, RISK = 1500, 0.001
#: Segments are looked up by this many of their first words.
LONGEST = 8
#: Candidates and cells of their windows that are held at a time.
CANDIDATES_AT_ONCE = 1 << 18
CELLS_AT_ONCE = 1 << 18
#: Items are searched for in blocks of this many, so what a task holds of them is bounded.
ITEMS_AT_ONCE = 20_000


class Table(NamedTuple):
    """A walk, the words that items have at its sampled steps, and their sorted codes with item and offset.

    Without a seed the pointer moves at every step, which reads a segment.
    """

    seed: int | None
    steps: tuple[int, ...]
    allowed: list[np.ndarray]
    codes: np.ndarray
    items: np.ndarray
    offsets: np.ndarray


def make_walk(span: int, number: int) -> tuple[int, tuple[int, ...]]:
    """The seed of a walk and the steps sampled, of which step 0 is always one."""
    rng = np.random.default_rng([span, number])
    reach = max(1, span * 3 // 2)
    later = rng.choice(np.arange(1, reach), min(SAMPLED, reach) - 1, replace=False)
    return int(rng.integers(1 << 62)), (0, *sorted(later.tolist()))


def _moves(hashes: np.ndarray, seed: int | None, step: int) -> np.ndarray:
    if seed is None:
        return np.ones(len(hashes), dtype=np.int8)
    factor = words.mix(np.array([seed + step], dtype=np.uint64))[0] | np.uint64(1)
    return ((hashes * factor) >> np.uint64(63)).astype(np.int8)


def walk(hashes: np.ndarray, seed: int | None, steps: tuple[int, ...]) -> np.ndarray:
    """Positions read at the sampled steps by the walk from word 0; may run past the end."""
    at, out = 0, []
    for step in range(steps[-1] + 1):
        if step in steps:
            out.append(at)
        if at < len(hashes):
            at += int(_moves(hashes[at : at + 1], seed, step)[0])
    return np.array(out)


def spread(number: int) -> float:
    """The number-th of a row of places in [0, 1) that fill it evenly: the bits of the number, mirrored."""
    out, part = 0.0, 0.5
    while number:
        out += part * (number & 1)
        number, part = number >> 1, part / 2
    return out


def sure_rate(misses: int, draws: int, target: float) -> bool:
    """Whether a rate below ``target`` would hardly (``RISK``) give so few misses: an exact binomial bound."""
    if target >= 1:
        return False
    p = 1 - target
    log_term = lambda i: (
        math.lgamma(draws + 1) - math.lgamma(i + 1) - math.lgamma(draws - i + 1) + i * math.log(p) + (draws - i) * math.log1p(-p)
    )
    return sum(math.exp(log_term(i)) for i in range(misses + 1)) <= RISK


def _changed(item: list, edits: int, kind: int, vocabulary: np.ndarray, rng: np.random.Generator) -> list:
    """The item after ``edits`` word edits: scattered (0), or in a block at the start, middle or end (1 to 3)."""
    out = list(item)
    if kind:
        at = (0, (len(out) - edits) // 2, len(out) - edits)[kind - 1]
        gone = rng.integers(2) and edits < len(out)
        out[at : at + edits] = [] if gone else vocabulary[rng.integers(len(vocabulary), size=edits)].tolist()
        return out
    for _ in range(edits):
        how, at = rng.integers(3), int(rng.integers(len(out)))
        word = vocabulary[rng.integers(len(vocabulary))]
        if how == 1:
            out.insert(at, word)
        elif how == 2 and len(out) > 1:
            del out[at]
        else:
            out[at] = word
    return out


class Index:
    """The items of one block, coded by every table."""

    def __init__(self, items: list[np.ndarray], similarity: float, target: float = 0.99) -> None:
        if not 0 < similarity <= 1:
            raise ValueError(f"similarity must be above 0 and at most 1, not {similarity}")
        if not 0 < target <= 1:
            raise ValueError(f"target must be above 0 and at most 1, not {target}")
        self.items = [i for i in items]
        self.edits = [int((1 - similarity) * len(i) + 1e-9) for i in items]
        self.vocabulary, back, times = np.unique(
            np.concatenate([*items, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True
        )
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[self.vocabulary >> np.uint64(44)] = True
        ends = np.cumsum([0, *(len(i) for i in items)])
        self.symbols = [back[a:b] + 1 for a, b in zip(ends[:-1], ends[1:])]
        self.times = [times[back[a:b]] for a, b in zip(ends[:-1], ends[1:])]
        bands: dict[int, list[int]] = {}
        for k, item in enumerate(items):
            if len(item):
                bands.setdefault(len(item) // BAND, []).append(k)
        #: Items that are searched for exactly.
        self.exact: list[int] = []
        walks: dict[tuple[int, int], list[int]] = {}
        for band, members in sorted(bands.items()):
            found = self._enough(band, members, target)
            coded = {int(k) for t in found for k in t.items}
            self.exact += [k for k in members if k not in coded]
            for number in range(len(found)):
                walks.setdefault((self._span(members), number), []).extend(members)
        # Bands that use the same walk share its table.
        self.tables = [self._walked(*w, members) for w, members in sorted(walks.items())]
        self.walks = len(self.tables)
        self.tables += self._segments(self.exact)

    def _span(self, members: list[int]) -> int:
        return next((s for s in SPANS if 3 * s <= min(len(self.items[k]) for k in members)), 1)

    def _walked(self, span: int, number: int, members: list[int]) -> Table:
        """The members' words at the sampled steps of a walk from a rare word of the part of the item that is its turn."""
        seed, steps = make_walk(span, number)
        rows = []
        for k in members:
            item, n = self.items[k], len(self.items[k])
            parts = max(1, n // span)
            part = int(spread(number) * parts)
            low, high = n * part // parts, n * (part + 1) // parts
            # Rare words first; a later turn of the same part begins at its next one. The last
            # places of an item leave no room for a walk; then the nearest before them.
            rare = low + np.argsort(self.times[k][low:high], kind="stable")
            turns = [*np.roll(rare, -(number // parts)), *range(low - 1, -1, -1)]
            for offset in map(int, turns):
                at = walk(item[offset:], seed, steps) + offset
                if at[-1] < n:
                    rows.append((k, offset, self.symbols[k][at]))
                    break
        return self._coded(seed, steps, rows)

    def _segments(self, members: list[int]) -> list[Table]:
        segments: dict[int, list[tuple]] = {}
        for k in members:
            n, edits = len(self.items[k]), self.edits[k]
            ends = [n * i // (edits + 1) for i in range(edits + 2)]
            for begin, end in zip(ends[:-1], ends[1:]):
                length = min(end - begin, LONGEST)
                if length:
                    segments.setdefault(length, []).append((k, begin, self.symbols[k][begin : begin + length]))
        return [self._coded(None, tuple(range(length)), rows) for length, rows in sorted(segments.items())]

    def _coded(self, seed: int | None, steps: tuple[int, ...], rows: list[tuple]) -> Table:
        symbols = np.array([r[2] for r in rows], dtype=np.int64).reshape(len(rows), len(steps))
        allowed = []
        for j in range(len(steps)):
            mask = np.zeros(len(self.vocabulary) + 1, dtype=bool)
            mask[symbols[:, j]] = True
            allowed.append(mask)
        codes = _fold(symbols.T)
        order = np.argsort(codes, kind="stable")
        item, offset = (np.array([r[i] for r in rows], dtype=np.int64)[order] for i in (0, 1))
        return Table(seed, steps, allowed, codes[order], item, offset)

    def _enough(self, band: int, members: list[int], target: float) -> list[Table]:
        """Tables that find edited members at the target rate, as far as the draws can make sure; none if they cannot."""
        span = self._span(members)
        rng = np.random.default_rng([band, len(members)])
        texts, wanted, kinds = [], [], []
        for kind in range(4):
            # Without edits all kinds are the same: an item that is coded is found.
            for k in rng.choice(members, DRAWS) if any(self.edits[k] for k in members) else ():
                texts.append(_changed(self.items[k].tolist(), self.edits[k], kind, self.vocabulary, rng))
                wanted.append(k)
                kinds.append(kind)
        hashes = np.array([x for t in texts for x in t], dtype=np.uint64)
        first = np.cumsum([0, *(len(t) for t in texts)])
        wanted, kinds = np.array(wanted, dtype=np.int64), np.array(kinds)
        found = np.zeros(len(texts), dtype=bool)
        tables: list[Table] = []
        for number in range(MOST_TABLES):
            tables.append(self._walked(span, number, members))
            for rows, _, items in self.candidates(hashes, first, tables[-1:]):
                found[rows[wanted[rows] == items]] = True
            if all(sure_rate(int((~found[kinds == kind]).sum()), DRAWS, target) for kind in set(kinds.tolist())):
                return tables
        return []

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """1 and up for words of any item, 0 for others."""
        out = np.zeros(len(hashes), dtype=np.int32)
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        if len(maybe) and len(self.vocabulary):
            place = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[place] == hashes[maybe], place + 1, 0)
        return out

    def candidates(self, hashes: np.ndarray, first: np.ndarray, tables: list[Table] | None = None) -> Iterator[np.ndarray]:
        """Rows (row, start of the window, item) of all windows that agree with an item in a table, a bounded number at a time."""
        tables = self.tables if tables is None else tables
        longest = max((t.steps[-1] for t in tables), default=0) + 1
        h = np.r_[hashes, np.zeros(longest, dtype=np.uint64)]
        ids = np.r_[self.ids(hashes), np.zeros(longest, dtype=np.int32)]
        some = np.flatnonzero(ids)
        hits = [np.zeros((4, 0), dtype=np.int64)]
        for number, table in enumerate(tables):
            origin = some[table.allowed[0][ids[some]]]
            at, read = origin, [ids[origin]]
            for step in range(1, table.steps[-1] + 1):
                at = at + _moves(h[at], table.seed, step - 1)
                if step in table.steps:
                    symbol = ids[at]
                    keep = table.allowed[len(read)][symbol]
                    origin, at, read = origin[keep], at[keep], [*(r[keep] for r in read), symbol[keep]]
            code = _fold(np.array(read))
            lo, hi = np.searchsorted(table.codes, code), np.searchsorted(table.codes, code, side="right")
            hits.append(np.stack([origin, np.full(len(origin), number), lo, hi - lo])[:, hi > lo])
        hit = np.concatenate(hits, axis=1)
        hit = hit[:, np.argsort(hit[0], kind="stable")]
        part = np.cumsum(hit[3]) // CANDIDATES_AT_ONCE
        for some in np.split(hit, np.flatnonzero(np.diff(part)) + 1, axis=1):
            found = [np.zeros((3, 0), dtype=np.int64)]
            for number, table in enumerate(tables):
                at, _, lo, many = some[:, some[1] == number]
                which = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                begin = np.repeat(at, many)
                row = np.searchsorted(first, begin, side="right") - 1
                found.append(np.stack([row, begin - table.offsets[which], table.items[which]]))
            whole = np.concatenate(found, axis=1)
            whole = whole[:, np.lexsort(whole)]
            fresh = np.ones(whole.shape[1], dtype=bool)
            fresh[1:] = (whole[:, 1:] != whole[:, :-1]).any(axis=0)
            yield whole[:, fresh]

    def matches(self, w: words.Words) -> tuple[np.ndarray, ...]:
        """(row, item, edits, start) of every row's best window for each item it holds."""
        best = [np.zeros((4, 0), dtype=np.int64)]
        for found in self.candidates(w.hashes, w.first):
            best.append(_best(np.concatenate([best.pop(), self._verified(w, *found)], axis=1)))
        rows, items, edits, starts = best[0]
        return rows, items, edits, np.maximum(starts - w.first[rows], 0)

    def _verified(self, w: words.Words, rows: np.ndarray, starts: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Rows (row, item, edits, start) of the candidates with no more edits than their items may have."""
        edits = np.full(len(starts), 1 << 30)
        most = np.array(self.edits, dtype=np.int64)[items] if len(items) else items
        lengths = np.array([len(self.items[k]) for k in items], dtype=np.int64)
        for n in np.unique(lengths):
            group = np.flatnonzero(lengths == n)
            k = int(most[group[0]])
            size = max(1, CELLS_AT_ONCE // int(n + 2 * k))
            for part in np.split(group, range(size, len(group), size)):
                window = starts[part][:, None] + np.arange(-k, n + k)[None, :]
                inside = (window >= w.first[rows[part]][:, None]) & (window < w.first[rows[part] + 1][:, None])
                text = np.where(inside, w.hashes[np.clip(window, 0, max(len(w.hashes) - 1, 0))], np.uint64(0))
                edits[part] = least_edits(np.stack([self.items[i] for i in items[part]]), text)
        return np.stack([rows, items, edits, starts])[:, edits <= most]


def _best(found: np.ndarray) -> np.ndarray:
    """Of rows (row, item, edits, start) the one with the fewest edits, then the earliest, by row and item."""
    found = found[:, np.lexsort(found[::-1])]
    fresh = np.ones(found.shape[1], dtype=bool)
    fresh[1:] = (found[:2, 1:] != found[:2, :-1]).any(axis=0)
    return found[:, fresh]


def _fold(symbols: np.ndarray) -> np.ndarray:
    code = np.zeros(symbols.shape[1], dtype=np.uint64)
    for row in symbols:
        code = words.mix(code + row.astype(np.uint64) + np.uint64(1))
    return code


def least_edits(items: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Least edit distance of each row of ``items`` to any stretch of the same row of ``texts``."""
    count, width = texts.shape
    steps = np.arange(width + 1)
    row = np.zeros((count, width + 1), dtype=np.int64)
    for i in range(items.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (texts != items[:, i : i + 1]), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row.min(axis=1)


def _indexes(docs: DataFrame, benchmark: DataFrame, similarity: float, target: float, text: str, item: str) -> Iterator:
    """Broadcast indexes of the benchmark, ``ITEMS_AT_ONCE`` items each, with the items' ids."""
    items = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    blocks = max(1, -(-items.count() // ITEMS_AT_ONCE))
    for block in range(blocks):
        held = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).orderBy("item", "text").toArrow()
        w = words.tokenize(held.column("text").combine_chunks())
        index = Index([w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:])], similarity, target)
        yield docs.sparkSession.sparkContext.broadcast((index, held.column("item").combine_chunks()))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    target: float = 0.99,
    text: str = "text",
    id: str = "doc_id",
    item: str = "item_id",
) -> DataFrame:
    """(id, item, n_words, edits, start): the benchmark items that documents contain.

    An item of ``n_words`` words is contained if some stretch of the document is at
    most (1 - ``similarity``) * n_words word edits away from it; ``edits`` is the least
    distance found, ``start`` the word where that window begins. Words are split at
    white space, A-Z count as a-z. A window with no edits is always found, one with the
    most edits allowed at the rate ``target`` at least, wherever its edits are. At 1 all
    items are searched for exactly, and every window is found.

    Items without words are in no document, texts without words hold none. Repeated
    rows give a row each, items that repeat are reported each, null ids stay null.
    Columns of other names are ignored. An empty table gives no rows. The benchmark is
    searched for in blocks of ``ITEMS_AT_ONCE`` items, each over all documents.
    """
    ids = dict(docs.dtypes)[id], dict(benchmark.dtypes)[item]
    slim = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = None
    for shared in _indexes(docs, benchmark, similarity, target, text, item):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = shared.value
            sizes = np.array([len(i) for i in index.items], dtype=np.int64)
            for batch in batches:
                for part in words.slices(batch, "text"):
                    rows, which, edits, start = index.matches(words.tokenize(part.column("text")))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("id").take(pa.array(rows, pa.int64())),
                            names.take(pa.array(which, pa.int64())),
                            pa.array(sizes[which], pa.int64()),
                            pa.array(edits, pa.int64()),
                            pa.array(start, pa.int64()),
                        ],
                        ["id", "item", "n_words", "edits", "start"],
                    )

        part = slim.mapInArrow(run, f"id {ids[0]}, item {ids[1]}, n_words long, edits long, start long")
        found = part if found is None else found.unionByName(part)
    return found.withColumnsRenamed({"id": id, "item": item})


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, target: float = 0.99, text: str = "text", item: str = "item_id"
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item; see ``find_contamination``."""
    for shared in _indexes(docs, benchmark, similarity, target, text, item):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value[0]
            for batch in batches:
                for part in words.slices(batch, text):
                    clean = np.ones(len(part), dtype=bool)
                    clean[index.matches(words.tokenize(part.column(text)))[0]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
