"""Features, gains and draws against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import resampling

DOCS = "doc_id long, text string, row string, score string, rank string, ID string, buckets string"
TARGET = "item_id long, text string, row string, _None string"
_A_Z = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(text, most=1):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_A_Z))
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)], len(w)


TEXTS = st.lists(st.none() | st.text(alphabet="aAbZé9ÿ \n\x00|", max_size=30), max_size=7)


@given(TEXTS, st.integers(1, 3))
def test_features(texts, most):
    bucket, first, n_words = resampling.features(pa.array(texts, pa.string()), most, 97)
    for i, text in enumerate(texts):
        want, words = plain(text, most)
        got = bucket[first[i] : first[i + 1]].tolist()
        assert got == [zlib.crc32(f.encode()) % 97 for f in want] and n_words[i] == words


def brute(docs, target, buckets=10_000, percent=10, least=20, most=1):
    counts = [0] * buckets, [0] * buckets
    for side, texts in enumerate(([t for _, t in docs], target)):
        for text in texts:
            for f in plain(text, most)[0]:
                counts[side][zlib.crc32(f.encode()) % buckets] += 1
    s_all, t_all = map(sum, counts)
    gain = [
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(*counts)
    ]
    out = []
    for id, text in docs:
        found, words = plain(text, most)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([id, len(found), weight, score, words])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {}
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        rank.setdefault((r[0], r[1], r[2]), []).append(k + 1)
    return sorted(
        [(*r[:4], rank[r[0], r[1], r[2]].pop(0) if rank.get((r[0], r[1], r[2])) and r[4] >= least else None) for r in out],
        key=str,
    )


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def corpus():
    docs = [(k, " ".join(f"w{(k * j) % 41}" for j in range(k % 60))) for k in range(300)]
    docs += [(7, docs[47][1])] * 40 + [(None, docs[59][1]), (None, None), (301, ""), (302, " Ä a " * 60_000), (303, None)]
    return docs, ["w1 w2 w3 w5", None, "", "W40 ä é " * 9]


def test_against_plain_python(spark, frame):
    docs, target = corpus()
    table = frame([(*r, "a", "b", "c", "d", "e") for r in docs], DOCS)
    goal = frame([(k, t, "", "") for k, t in enumerate(target)], TARGET)
    for options in ({}, {"most": 2, "percent": 45, "buckets": 50}, {"percent": 100}, {"percent": 0}, {"least_words": 10**6}):
        want = {"least" if k == "least_words" else k: v for k, v in options.items()}
        assert rows(resampling.resample(table, goal, **options)) == brute(docs, target, **want)


def test_empty(spark, frame):
    docs, target = corpus()
    none, goal = frame([], DOCS), frame([], TARGET)
    assert resampling.resample(none, goal).count() == 0
    table = frame([(*r, "", "", "", "", "") for r in docs], DOCS)
    assert rows(resampling.resample(table, goal)) == brute(docs, [])


def test_counts_come_from_every_task(spark, frame):
    docs, _ = corpus()
    found = resampling.hashed_features(frame([(*r, "", "", "", "", "") for r in docs], DOCS, 7), "text", "doc_id", 1, 101)
    assert resampling.bucket_counts(found, 101).sum() == sum(len(plain(t)[0]) for _, t in docs)
