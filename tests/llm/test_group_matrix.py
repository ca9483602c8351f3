"""Similar documents against all pairs."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import group_matrix
from tidemark.llm.queries import op9_ngram_jaccard
from tests.llm.test_words import plain

SCHEMA = "doc_id long, text string, n string, cls string, component_id string"


def shingles(text, n):
    w = plain(text)
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset({tuple(w)} - {()})


def all_pairs(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            both = len(s & t)
            if s and t and None not in (sets[a][0], sets[b][0]) and 100 * both >= percent * (len(s) + len(t) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)] if s and i is not None else i) for k, (i, s) in enumerate(sets) if i is not None)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.7))}"
    text = lambda n: [word() for _ in range(n)]
    base, line, texts = text(60), text(12), []
    for _ in range(150):  # a family of copies, each with its own edits
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = word() + "x"
        texts.append(copy)
    for _ in range(150):  # others that share a line, some copied with an edit
        other = text(rng.randrange(1, 80))
        other[rng.randrange(len(other)):0] = line
        texts.append(other)
        if rng.random() < 0.3:
            texts.append([*other, word()])
    texts += [base] * 40 + [text(k) for k in (0, 1, 2, 3, 4) for _ in range(3)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(9000, None), (9001, "  "), (None, rows[0][1]), (rows[3][0], rows[3][1]), (9002, "Z " * 30_000), (9003, "z " * 30_001)]


@pytest.mark.parametrize("n,percent,small", [(4, 85, False), (5, 80, True), (1, 60, True)])
def test_against_all_pairs(spark, frame, monkeypatch, n, percent, small):
    if small:  # many groups, many tasks, everything frequent
        monkeypatch.setattr(group_matrix, "GROUP", 7)
        monkeypatch.setattr(group_matrix, "QUERIES", 5)
        monkeypatch.setattr(group_matrix, "FREQUENT", 2)
    rows = corpus(n)
    got = group_matrix.similar_documents(frame([(*r, "a", "b", "c") for r in rows], SCHEMA), n, percent).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == all_pairs(rows, n, percent)
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_copies_of_one_text_ask_one_head(spark, frame, monkeypatch):
    """Each is similar to the text that it was made from, no two to each other: nothing is left to ask of groups."""
    rng = random.Random(8)
    base, rows = [f"b{k}" for k in range(200)], []
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(4, 196), 2):
            copy[at] = f"x{i}at{at}"
        rows.append((i, " ".join(copy)))
    rows[70:70] = [(500, " ".join(base)), (501, " ".join(base))]
    written, through = {}, group_matrix.write_through

    def kept(df, label, **more):
        written[label] = through(df, label, **more)
        return written[label]

    monkeypatch.setattr(group_matrix, "write_through", kept)
    docs = frame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(16)
    got = group_matrix.similar_documents(docs, 4, 85).collect()
    assert sorted(tuple(r) for r in got) == all_pairs(rows, 4, 85)
    assert written["star-queries"].select("gid").distinct().count() == 1
    assert written["queries"].count() == 0


def test_keep_one(spark, frame):
    rows = corpus(2)
    kept = group_matrix.keep_one(frame([(*r, "a", "b", "c") for r in rows], SCHEMA))
    assert kept.columns == ["doc_id", "text", "n", "cls", "component_id"]
    want = {i for i, _, c in all_pairs(rows, 5, 80) if i == c}
    assert {r.doc_id for r in kept.collect()} == want | {None}


def test_keep_one_row_of_each_text_under_repeated_ids(spark, frame):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(3, a), (5, a), (5, b), (7, b), (3, a), (7, b), (9, ""), (9, ""), (None, a)]
    kept = group_matrix.keep_one(frame([(*r, "x", "y", "z") for r in rows], SCHEMA)).collect()
    got = sorted((str(r.doc_id), r.text) for r in kept)
    assert got == [("3", a), ("5", b), ("9", ""), ("9", ""), ("None", a)]


def test_empty(spark, frame):
    assert group_matrix.similar_documents(frame([], SCHEMA)).count() == 0
    blank = frame([(2, None, "", "", ""), (1, "", "", "", "")], SCHEMA)
    assert sorted(tuple(r) for r in group_matrix.similar_documents(blank).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_query_against_all_pairs(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    assert sorted(tuple(r) for r in op9_ngram_jaccard(spark, folder).collect()) == all_pairs(rows, 4, 85)
