"""Windows against exact edit distance everywhere, and the rate at which edited items are found."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import decontaminate as dc
from tidemark.llm.queries import op10_decontamination
from tests.llm.test_words import plain

DOCS = "doc_id long, text string, id string, item string, edits string"
ITEMS = "item_id long, text string, id string, item string"


def least(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(docs, items, similarity=0.8):
    out = {}
    for d, text in docs:
        w = plain(text)
        for i, item in items:
            p = plain(item)
            if p and w and (k := least(p, w)) <= int((1 - similarity) * len(p) + 1e-9):
                out[d, i] = k
    return out


@given(st.lists(st.integers(1, 3), min_size=1, max_size=7), st.lists(st.integers(1, 4), min_size=1, max_size=12))
def test_edit_distance(item, text):
    got = dc.least_edits(np.array([item], dtype=np.uint64), np.array([text], dtype=np.uint64))
    assert got[0] == least(item, text)


def planted(seed=0):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 5000}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 3, 5, 9, 16, 30, 45, 60] * 6)]
    items += [(900, None), (901, " "), (902, items[20][1]), (None, items[7][1])]
    docs = []
    for k in range(300):
        text = [word() + "z" for _ in range(rng.randrange(60))]
        _, item = items[rng.randrange(48)]
        copy = item.split()
        for _ in range(rng.randrange(int(0.2 * len(copy)) + 2)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
            copy = copy or [word()]
        at = rng.randrange(len(text) + 1)
        docs.append((k, "\n".join([*text[:at], *copy, *text[at:]]).upper()))
    return [*docs, (1000, None), (1001, ""), (1002, "x " * 50_000)], items


def test_against_edit_distance_everywhere(spark, frame):
    docs, items = planted()
    found = dc.find_contamination(frame([(*r, "", "", "") for r in docs], DOCS), frame([(*r, "", "") for r in items], ITEMS))
    got = {(r.doc_id, r.item_id): r.edits for r in found.collect()}
    want = brute(docs, items)
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert all(k in got for k, edits in want.items() if edits == 0)
    assert len(got) >= 0.97 * len(want)


def changed(item, edits, word, rng):
    copy = item.split()
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(copy))
        copy[at : at + (kind != 1)] = [word()] * (kind != 2)
        copy = copy or [word()]
    return " ".join(copy)


def test_small_benchmarks_lose_no_edited_copy(spark, frame):
    """At a target of 1 every item is searched for by its segments, and nothing is lost."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    for count in (1, 10):
        items = [(k, " ".join(word() for _ in range(rng.randrange(16, 60)))) for k in range(count)]
        docs = []
        for k in range(200):
            _, item = items[k % count]
            copy = changed(item, len(item.split()) // 5, word, rng)
            docs.append((k, " ".join(["out"] * rng.randrange(9)) + f" {copy} out"))
        found = dc.find_contamination(frame([(*r, "", "", "") for r in docs], DOCS), frame([(*r, "", "") for r in items], ITEMS), target=1.0)
        got = {(r.doc_id, r.item_id): r.edits for r in found.collect()}
        assert got == brute(docs, items) and len(got) >= 200


def test_blocks_of_edits_anywhere(spark, frame):
    rng = random.Random(6)
    for count in (1, 40):
        items = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(16, 60)))) for k in range(count)]
        docs = []
        for k, item in items:
            w = item.split()
            n = len(w) // 5
            for at in (0, (len(w) - n) // 2, len(w) - n):
                docs.append((len(docs), " ".join([*w[:at], *["other"] * n, *w[at + n :]])))
                docs.append((len(docs), " ".join([*w[:at], *w[at + n :]])))
        found = dc.find_contamination(frame([(*r, "", "", "") for r in docs], DOCS), frame([(*r, "", "") for r in items], ITEMS), target=1.0)
        assert {(r.doc_id, r.item_id): r.edits for r in found.collect()} == brute(docs, items)


def test_exact_copies_of_short_items(spark, frame):
    rng = random.Random(7)
    items = [(k, " ".join(f"w{rng.randrange(9000)}" for _ in range(2 + k % 2))) for k in range(2000)]
    docs = [(k, f"x {item} y") for k, item in items]
    found = dc.find_contamination(frame([(*r, "", "", "") for r in docs], DOCS), frame([(*r, "", "") for r in items], ITEMS))
    assert {(k, k) for k, _ in items} <= {(r.doc_id, r.item_id) for r in found.collect()}


def test_blocks_of_items_and_dropping(spark, frame, monkeypatch):
    docs, items = planted(1)
    table, bench = frame([(*r, "a", "b", "c") for r in docs], DOCS), frame([(*r, "", "") for r in items], ITEMS)
    once = sorted(map(str, dc.find_contamination(table, bench).select("doc_id", "item_id").collect()))
    hit = {r.doc_id for r in dc.find_contamination(table, bench).collect()}
    clean = dc.drop_contaminated(table, bench)
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - hit
    monkeypatch.setattr(dc, "ITEMS_AT_ONCE", 11)
    parts = {str(r) for r in dc.find_contamination(table, bench).select("doc_id", "item_id").collect()}
    assert len(parts ^ set(once)) <= 0.03 * len(once)


def test_empty(spark, frame):
    none, bench = frame([], DOCS), frame([(1, "a b c", "", "")], ITEMS)
    assert dc.find_contamination(none, bench).count() == 0
    doc = frame([(1, "a b c", "", "", "")], DOCS)
    assert dc.find_contamination(doc, frame([], ITEMS)).count() == 0
    assert dc.drop_contaminated(doc, frame([], ITEMS)).count() == 1
    assert dc.drop_contaminated(doc, bench).count() == 0


def test_query_against_edit_distance_everywhere(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' WHERE length(text) < 3000").fetchall()[:60]
    items = duckdb.sql(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id): r.edits for r in op10_decontamination(spark, folder).collect()}
    few = {d for d, _ in docs}
    assert {k: v for k, v in got.items() if k[0] in few} == brute(docs, items)
    assert got


def drawn(items, kind, rng, vocabulary):
    """The items with as many word edits as they may have, made apart from those that tables are chosen by."""
    out = []
    for w in items:
        copy, n = list(w), len(w) // 5
        if kind == "scattered":
            for at in sorted(rng.sample(range(len(w)), n), reverse=True):
                copy[at : at + 1] = rng.choice(([rng.choice(vocabulary)], [], [copy[at], rng.choice(vocabulary)]))
        else:
            at = {"start": 0, "middle": (len(w) - n) // 2, "end": len(w) - n}[kind]
            copy[at : at + n] = rng.choice(([], [rng.choice(vocabulary) for _ in range(n)]))
        out.append(copy)
    return out


@pytest.mark.parametrize("count, words_known", [(1, 500), (10, 500), (200, 900)])
def test_recall_on_edits_that_chose_no_table(count, words_known):
    """Walks find edited items at the target rate, wherever the edits are and however few the items."""
    rng = random.Random(count)
    vocabulary = [int(x) for x in np.random.default_rng(1).integers(1, 1 << 63, words_known)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 60))] for _ in range(count)]
    index = dc.Index([np.array(i, dtype=np.uint64) for i in items], 0.8, 0.99)
    assert index.walks and not index.exact
    for kind in ("scattered", "start", "middle", "end"):
        tried = [k % count for k in range(1200)]
        texts = drawn([items[k] for k in tried], kind, rng, vocabulary)
        hashes = np.array([x for t in texts for x in t], dtype=np.uint64)
        first = np.cumsum([0, *map(len, texts)])
        w = dc.words.Words(hashes, first, None, None, None)
        rows, which, edits, _ = index.matches(w)
        found = {(r, k) for r, k in zip(rows.tolist(), which.tolist())}
        assert np.mean([(r, k) in found for r, k in enumerate(tried)]) >= 0.985, kind
        # What is found is within the edits allowed, by plain edit distance.
        for r, k, e in list(zip(rows.tolist(), which.tolist(), edits.tolist()))[:15]:
            assert e == least(items[k], texts[r]) <= len(items[k]) // 5


def test_target_sets_the_number_of_tables():
    rng = np.random.default_rng(3)
    items = [rng.integers(1, 1 << 40, n).astype(np.uint64) for n in range(15, 60)]
    walks = [dc.Index(items, 0.8, target).walks for target in (0.5, 0.9, 0.99)]
    assert 0 < walks[0] < walks[1] < walks[2] <= 2 * dc.MOST_TABLES
    # Beyond what the draws can make sure, items are searched for exactly.
    for target in (0.99999, 1.0):
        exact = dc.Index(items, 0.8, target)
        assert exact.walks == 0 and sorted(exact.exact) == list(range(len(items)))
    with pytest.raises(ValueError):
        dc.Index(items, 0.8, 0.0)


def test_binomial_bound_of_the_rate():
    assert dc.sure_rate(0, 688, 0.99) and not dc.sure_rate(0, 686, 0.99)
    assert not dc.sure_rate(15, 1500, 0.99) and dc.sure_rate(0, 10, 0.4)


def test_anchors_are_spread_over_the_item():
    item = np.arange(1, 49, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    index = dc.Index([item], 0.8, 0.99)
    parts = {int(t.offsets[0]) * 4 // 48 for t in index.tables}
    assert parts == {0, 1, 2, 3}


def test_ties_between_items_and_repeated_rows(spark, frame):
    a, b = "p q r s t u v w x y", "p q r s t u v w x z"
    docs = frame([(1, "p q r s t u v w x n", "", "", ""), (1, "p q r s t u v w x n", "", "", "")], DOCS)
    found = dc.find_contamination(docs, frame([(1, a, "", ""), (2, b, "", ""), (2, b, "", "")], ITEMS))
    got = sorted((r.doc_id, r.item_id, r.edits) for r in found.collect())
    assert got == sorted([(1, 1, 1), (1, 2, 1), (1, 2, 1)] * 2)
