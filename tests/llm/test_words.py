"""Words, hashes and shingle sets against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import words

TEXTS = st.lists(st.none() | st.text(alphabet="aAbZé \t\n\x0b\x1c ", max_size=40), max_size=8)


def plain(text):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))


@given(TEXTS, st.integers(0, 3))
def test_words_and_sets(texts, skip):
    array = pa.array([*["pad x"] * skip, *texts], pa.string()).slice(skip)
    w = words.tokenize(array)
    seen = {}
    for i, text in enumerate(texts):
        a, b = w.first[i], w.first[i + 1]
        got = [w.data[s:e].tobytes().decode() for s, e in zip(w.starts[a:b], w.ends[a:b])]
        assert got == plain(text)
        for word, h in zip(got, w.hashes[a:b]):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    for n in (2, 4):
        hashes, first = words.shingle_sets(w, n)
        by_set = {}
        for i, text in enumerate(texts):
            p = plain(text)
            want = {tuple(p[k : k + n]) for k in range(len(p) - n + 1)} if len(p) >= n else {tuple(p)} - {()}
            row = hashes[first[i] : first[i + 1]]
            assert len(row) == len(want) and (np.diff(row.astype(object)) > 0).all()
            assert by_set.setdefault(frozenset(want), row.tobytes()) == row.tobytes()
        assert len(set(by_set.values())) == len(by_set)


def test_very_long_words_and_slices():
    long = "x" * 3_000_000
    texts = pa.array([long, "a b", None, "y " * 900_000, ""])
    w = words.tokenize(texts)
    assert np.diff(w.first).tolist() == [1, 2, 0, 900_000, 0]
    batch = pa.RecordBatch.from_arrays([texts], ["t"])
    parts = list(words.slices(batch, "t"))
    assert sum(len(p) for p in parts) == 5 and len(parts) > 1
