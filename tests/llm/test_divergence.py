"""Packed terms and the whole audit against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, Term string, n string, tile string, p string"
_A_Z = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(text):
    return [t.translate(_A_Z) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 3)), max_size=60))
def test_radix_order(pairs):
    a, b = (np.array([p[k] for p in pairs], dtype=np.uint64) for k in (0, 1))
    assert divergence.radix_order([b, a]).tolist() == np.lexsort((a, b)).tolist()


TEXT = st.lists(
    st.one_of(st.text(alphabet="abABéÉß", min_size=1, max_size=40), st.sampled_from([" ", "\n", "1", "\x00", "_", "z" * 300])),
    max_size=15,
).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["en", "de", ""]), st.sampled_from(["x", "y"]), TEXT), min_size=1, max_size=12))
def test_counts_of_a_batch(rows):
    n, docs = Counter(), Counter()
    for lang, source, text in rows:
        n[lang, source, ""] += 0
        docs[lang, source, ""] += 0
        for t, k in Counter(plain(text)).items():
            n[lang, source, t] += k
            docs[lang, source, t] += 1
    batch = divergence.count_terms(*[pa.array([r[k] for r in rows], pa.string()) for k in range(3)])
    got = sorted(tuple(r.values()) for r in batch.to_pylist())
    assert got == sorted((*k, n[k], docs[k]) for k in n)


def brute(rows, least=30, prior=5, top=50):
    docs, groups = {}, {}
    for _, text, lang, source, *_ in rows:
        lang, source, found = lang or "", source or "", plain(text)
        docs.setdefault(lang, Counter()).update(set(found))
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(found)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, d in docs[lang].items() if d >= least)

        def share(count):
            total = sum(count[t] for t in kept) + prior * len(kept)
            return [1 + 10**9 * (count[t] + prior) // total for t in kept]

        q = share(sum(sources.values(), Counter()))
        p = {s: share(c) for s, c in sources.items()}
        for s in sources:
            best = sorted(((b - a, t.encode()) for t, a, b in zip(kept, p[s], q) if sources[s][t] and a > b))[:top]
            out += [(lang, s, "term", t.decode(), -f, k + 1) for k, (f, t) in enumerate(best)]
            far = sorted((-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -f, k + 1) for k, (f, o) in enumerate(far)]
    return sorted(out)


def rows(seed=0):
    rng = random.Random(seed)
    word = lambda: rng.choice(["The", "of", "ÉTÉ", "naïve", "Donaudampfschifffahrt", "q" * 70, "ab1cd", "x-y", f"r{rng.randrange(30)}z"])
    out = []
    for k in range(500):
        source = rng.choice(["hot", "hot", "hot", "b", "c", "Ä", None, ""])
        text = rng.choice([None, "", "12 3"]) if k % 9 == 0 else " ".join(word() for _ in range(rng.randrange(30)))
        out.append((k, text, rng.choice(["en", "de", None, ""]), source, "a", "b", "c", "d"))
    out += [(900, None, "es", "s1", "", "", "", ""), (901, "a b", "es", "s2", "", "", "", "")]
    out += [out[1]] * 40 + [(902, "long " * 100_000, "en", "b", "", "", "", ""), (903, "m" * 200_000, "en", "b", "", "", "", "")]
    return out


@pytest.mark.parametrize("least, top, tile, block", [(30, 50, 128, 4096), (3, 2, 2, 5), (10**6, 50, 128, 4096)])
def test_against_plain_python(spark, frame, monkeypatch, least, top, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK", block)
    data = rows()
    got = divergence.audit_sources(frame(data, DOCS), least_docs=least, top=top)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == brute(data, least, 5, top)


def test_empty(spark, frame):
    assert divergence.audit_sources(frame([], DOCS)).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, total, kept = 123_456_789_012_345, 987_654_321_098_765, 777_777
    got = spark.range(1).select(divergence._share(F.lit(n), F.lit(total), F.lit(kept), 5)).head()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * kept)
