"""Revisits against a plain search, and headers that may change."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.queries import OP2_SQL, captures, op2_warc_revisits
from tools.compare import compare, duck

SCHEMA = (
    "record_id long, url string, ts long, kind string, status int,"
    " headers array<struct<name:string,value:string>>, mark string, canonical_url string"
)


def plain(records):
    out = {}
    for r in records:
        if r["kind"] != "revisit":
            continue
        best = None
        for o in records:
            if o["kind"] == "response" and o["status"] == 200 and o["page"] == r["page"] and None not in (r["page"], o["ts"], r["ts"]):
                if o["ts"] < r["ts"] and (best is None or (o["ts"], o["record_id"]) > (best["ts"], best["record_id"])):
                    best = o
        if best is None:
            out[r["record_id"]] = ("no_original", None)
            continue
        same = None
        for name in ("etag", "last-modified"):
            a, b = ({k.lower(): v for k, v in reversed(x["headers"] or [])}.get(name) for x in (r, best))
            if a is not None and b is not None:
                same = a.removeprefix("W/") == b.removeprefix("W/")
                break
        status = "no_validator" if same is None else "resolved" if same else "mismatch"
        out[r["record_id"]] = (status, best["record_id"] if same else None)
    return out


def test_against_plain_search(spark, frame):
    rng = random.Random(3)
    rows = []
    for k in range(400):
        hot = rng.random() < 0.4
        url = "http://Hot.example/#f" if hot else rng.choice(["http://a.example/x", "http://a.example:80/x?utm_a=1", "https://b.example", None])
        tag = rng.choice([None, '"1"', 'W/"1"', '"2"'])
        time = rng.choice([None, "t1", "t2"])
        headers = [(n, v) for n, v in (("ETag", tag), ("last-modified", time)) if v] if rng.random() < 0.9 else None
        rows.append((k, url, rng.choice([None, *range(60)]), rng.choice(["response", "revisit", "request"]), rng.choice([200, 404]), headers, "m", "c"))
    table = frame(rows, SCHEMA)
    pages = {r.record_id: r.page for r in table.select("record_id", warc.canonical_url(F.col("url")).alias("page")).collect()}
    names = ["record_id", "url", "ts", "kind", "status", "headers"]
    want = plain([{**dict(zip(names, r)), "page": pages[r[0]]} for r in rows])
    got = {r.record_id: (r.status, r.original_id) for r in warc.resolve_revisits(table).collect()}
    assert got == want
    assert {s for s, _ in got.values()} == {"no_original", "no_validator", "resolved", "mismatch"}
    assert warc.resolve_revisits(frame([], SCHEMA)).count() == 0


def test_times_that_are_not_whole_numbers(spark, frame):
    tag = [("etag", '"1"')]
    at = [(1, 1.0, "response"), (2, 1.25, "response"), (3, 1.5, "revisit"), (4, 1.5, "response"), (5, 1.75, "revisit"), (6, 1.0, "revisit")]
    rows = [(k, "http://h/", ts, kind, 200, tag, "m", "c") for k, ts, kind in at]
    table = frame(rows, SCHEMA.replace("ts long", "ts double"))
    want = {3: 2, 5: 4, 6: None}
    for kind in ("double", "timestamp"):
        got = warc.resolve_revisits(table.withColumn("ts", F.col("ts").cast(kind))).collect()
        assert {r.record_id: r.original_id for r in got} == want


def test_headers_that_may_change(spark, frame):
    old = [("Content-Type", "text/html"), ("Age", "1"), ("ETag", '"a"'), ("Set-Cookie", "x"), ("set-cookie", "y")]
    new = [("etag", '"a"'), ("content-type", "no"), ("AGE", "2"), ("Connection", "close"), ("Vary", "v")]
    rows = [(1, "http://h/", 1, "response", 200, old, "", ""), (2, "http://h", 2, "revisit", 304, new, "", ""), (2, "http://h", 2, "revisit", 304, new, "", "")]
    got = warc.resolve_revisits(frame(rows, SCHEMA)).collect()
    assert len(got) == 2
    assert [tuple(h) for h in got[0].headers] == [
        ("Content-Type", "text/html"), ("Set-Cookie", "x"), ("set-cookie", "y"), ("etag", '"a"'), ("AGE", "2"), ("Vary", "v"),
    ]


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.org:80/A?utm_x=1&b=2#f": "http://www.example.org/A?b=2",
        "https://example.org:443": "https://example.org/",
        "https://example.org:80/?q": "https://example.org:80/?q",
        "nothing": "nothing",
    }
    table = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r.u: r.c for r in table.select("u", warc.canonical_url(F.col("u")).alias("c")).collect()}
    assert got == cases


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), op2_warc_revisits, OP2_SQL, folder) is None


def test_query_against_plain_search(spark):
    folder = "/root/testdata/sf0.001"
    records = [
        {**r.asDict(), "headers": [tuple(h) for h in r.headers]}
        for r in captures(spark, folder).withColumn("page", warc.canonical_url(F.col("url"))).collect()
    ]
    got = {r.record_id: (r.status, r.original_id) for r in op2_warc_revisits(spark, folder).collect()}
    assert got == plain(records)
