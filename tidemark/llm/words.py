"""Words and their 64-bit hashes for whole Arrow columns of text, without a loop over rows.

A word is a run of bytes other than space and 0x09-0x0D. A-Z count as a-z.
Hashes depend on the bytes of the word alone, so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, made when first needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, _SLICE + 1)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (
                np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, dtype=np.uint64)])
                for b in (_BASE, inverse)
            )
        return self.up, self.down


_POWERS = _Powers()


class Words(NamedTuple):
    """Words of a column: ``first[i]:first[i + 1]`` are the words of row ``i``."""

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column and the offsets of its rows; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def tokenize(texts: pa.Array) -> Words:
    """Words of every row in order, with hashes and byte positions in the lower-cased data."""
    raw, offsets = text_bytes(texts)
    data = _LOWER[raw]
    inside = ~_SPACE[data]
    starts_mask = inside.copy()
    starts_mask[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts_mask[edges] = inside[edges]
    starts = np.flatnonzero(starts_mask)
    ends_mask = inside.copy()
    ends_mask[:-1] &= ~inside[1:]
    ends_mask[edges - 1] = inside[edges - 1]
    ends = np.flatnonzero(ends_mask) + 1
    hashes = _hash_runs(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    return Words(hashes, first, data, starts, ends)


def _hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each run of bytes, by differences of running sums, slice by slice."""
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        last = max(k + 1, int(np.searchsorted(ends, starts[k] + _SLICE, side="right")))
        base, size = starts[k], ends[last - 1] - starts[k]
        up, down = _POWERS.get(size + 1)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[base : base + size]] * up[:size], out=sums[1:])
        s, e = starts[k:last] - base, ends[k:last] - base
        out[k:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        k = last
    return mix(out)


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most_bytes`` of text each; a longer text is a part alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(size)
    if len(sizes) > begin:
        yield batch.slice(begin, len(sizes) - begin)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words by row: sorted hashes, and where each row's begin.

    A row of fewer words has its whole sequence as the only shingle, a row without
    words none.
    """
    factors = [np.uint64(pow(int(_BASE), k + 1, 1 << 64)) for k in range(n)]
    h, total = words.hashes, len(words.hashes)
    sums = np.zeros(max(total - n + 1, 0), dtype=np.uint64)
    for k in range(n):
        sums += h[k : k + len(sums)] * factors[k]
    sums = mix(sums + np.uint64(n))
    out, first = [], [0]
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            row = np.sort(sums[a : b - n + 1])
            fresh = np.empty(len(row), dtype=bool)
            fresh[0] = True
            np.not_equal(row[1:], row[:-1], out=fresh[1:])
            out.append(row[fresh])
        elif b > a:
            short = (h[a:b] * np.array(factors[: b - a])).sum(dtype=np.uint64)
            out.append(mix(np.array([short + np.uint64(b - a)])))
        else:
            first.append(first[-1])
            continue
        first.append(first[-1] + len(out[-1]))
    hashes = np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
    return hashes, np.array(first)
