"""Statistics against plain Python, bounds against exact fractions, verdicts against SQL."""

from __future__ import annotations

import random
import re
import sys
from fractions import Fraction
from math import comb
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as qr
from tidemark.llm.queries import op12_quality_rules, op12_sql

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

DOCS = "doc_id long, text string, lang string, id string, Stratum string, words string, levels string"
LABELS = "doc_id long, quality int, toxic int, text string, good string"


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for p in range(len(w) - 7):
        at.setdefault(tuple(w[p : p + 8]), []).append(p)
    covered = {q for ps in at.values() if len(ps) > 1 for p in ps for q in range(p, p + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )


def texts():
    rng = random.Random(1)
    word = lambda: rng.choice(["a", "bb", "Ça", "d#", "e|", "😀", "x" * 30])
    out = [None, "", " ", "\n\n", "a", "a " * 7, "a " * 8, "a " * 9, "b c d e f g h i b c d e f g h i", "w " * 40_000]
    for _ in range(150):
        line = [" ".join(word() for _ in range(rng.randrange(14))) for _ in range(4)]
        out.append(rng.choice(["\n", "\n\n", "\r\n", " "]).join(rng.choice(line) for _ in range(rng.randrange(1, 12))))
    block = " ".join(f"k{j}" for j in range(3000))
    return [*out, f"{block}\n{block}", "\x1cone\x0btwo\x0cthree\x85four " * 3]


def test_statistics(spark, frame):
    rows = [(k, t, None if k % 7 == 0 else "en", "a", "b", "c", "d") for k, t in enumerate(texts())]
    rows += [(3, "a", "en", "", "", "", ""), (3, "a", "en", "", "", "", ""), (None, "a b", "", "", "", "", "")]
    got = qr.judge_quality(frame(rows, DOCS), frame([(None, 1, 0, "", ""), (4, None, 0, "", "")], LABELS))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(
        ((r[0], *plain(r[1]), not plain(r[1])[-1]) for r in rows), key=str
    )
    assert qr.judge_quality(frame([], DOCS), frame([], LABELS)).count() == 0


@pytest.mark.parametrize("alpha", [0.01, 0.3])
def test_binomial_bound(spark, alpha):
    cases = [(k, n) for n in (0, 1, 7, 50, 400, 5000) for k in {0, 1, 3, n // 100, n // 5, n // 4, n} if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("p", qr.at_most(F.col("k"), F.col("n"), alpha))
    a = Fraction(alpha).limit_denominator(1000)
    for k, n, p in df.collect():
        if k >= alpha * n:
            assert p == 1.0
            continue
        exact = float(sum(comb(n, i) * a**i * (1 - a) ** (n - i) for i in range(k + 1)))
        assert p == pytest.approx(exact, rel=1e-8, abs=1e-300)


def test_bound_of_many_trials(spark):
    """A billion trials: a sum over a bounded number of terms, not below the normal value."""
    k = 10_000_000 - 3 * 3147
    p = spark.range(1).select(qr.at_most(F.lit(k).cast("long"), F.lit(10**9).cast("long"), 0.01)).head()[0]
    assert 0.0012 < p < 0.0015


RULE = qr.Rule("n_symbols", "n_words", 100, False, (90, 60, 30, 10))


def labelled(frame, spec, lang="en"):
    """Documents of 100 words, with so many symbols, and their labels: (symbols, good, how many)."""
    docs, marks = [], []
    for symbols, good, count in spec:
        for _ in range(count):
            k = len(docs)
            text = " ".join(f"w{k}x{j}{'#' if j < symbols else ''}" for j in range(100))
            docs.append((k, text, lang, "", "", "", ""))
            marks.append((k, good, 0, "", ""))
    return frame(docs, DOCS), frame(marks, LABELS)


def cutoff(docs, marks, **options):
    stats = qr.text_statistics(docs, "text", "doc_id", "lang").withColumn("levels", F.array(qr.strictness(RULE)))
    known = marks.select(F.col("doc_id").alias("id"), (F.col("quality") != 0).alias("good"))
    return [(r.cutoff, r.good_rejected) for r in qr.certified_cutoffs(stats, known, (RULE,), **options).collect()]


def test_cutoffs(spark, frame):
    # 0.95 ** 59 is the first power below 0.05: one good document fewer certifies nothing.
    assert cutoff(*labelled(frame, [(0, 1, 59), (70, 0, 5)]), alpha=0.05) == [(60, 0)]
    assert cutoff(*labelled(frame, [(0, 1, 58), (70, 0, 5)]), alpha=0.05) == []
    # The strictest cutoff that separates best and is certified; a failed one ends the row.
    spec = [(0, 1, 200), (35, 1, 4), (40, 0, 20), (70, 0, 5)]
    assert cutoff(*labelled(frame, spec), alpha=0.05) == [(30, 4)]
    assert cutoff(*labelled(frame, [*spec, (35, 1, 3)]), alpha=0.05) == [(60, 0)]
    # No bad document: the rule has no use and is off.
    assert cutoff(*labelled(frame, [(0, 1, 300)]), alpha=0.05) == []


def test_false_rejections_stay_below_the_bound(spark, frame):
    """Labels drawn again and again: hardly ever does a certified cutoff reject more than alpha."""
    rng, alpha, broken = random.Random(3), 0.1, 0
    for _ in range(8):
        spec = [(rng.choices([0, 20, 40, 70, 95], [80, 8, 6, 4, 2])[0], 1, 1) for _ in range(150)]
        spec += [(rng.choice([20, 40, 70, 95]), 0, 1) for _ in range(40)]
        for cut, _ in cutoff(*labelled(frame, spec), alpha=alpha):
            broken += {90: 0.02, 60: 0.06, 30: 0.12, 10: 0.2}[cut] > alpha
    assert broken <= 1


@pytest.mark.parametrize("alpha, delta", [(0.02, 0.05), (0.5, 0.2)])
def test_verdicts_against_sql(spark, alpha, delta):
    folder = "/root/testdata/sf0.01"
    for name in ("documents", "labels"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    if alpha == 0.02:
        got = op12_quality_rules(spark, folder)
    else:
        docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
        got = qr.judge_quality(docs, labels, alpha=alpha, delta=delta).withColumn("failed_rules", F.array_join("failed_rules", " "))
        assert got.filter("failed_rules <> ''").count() > 40
    want = duckdb.sql(op12_sql(alpha, delta))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(want.fetchall())


def test_no_python_in_the_plan(spark):
    folder = "/root/testdata/sf0.001"
    plan = op12_quality_rules(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
