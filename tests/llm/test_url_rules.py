"""Rules against a plain search over all of them."""

from __future__ import annotations

import random

from tidemark.llm.queries import OP3_SQL, op3_url_filters
from tidemark.llm.url_rules import judge_urls
from tools.compare import compare, duck

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, rule string, host string, mark string"


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for h, p, v in rules:
        if h is None or v is None:
            continue
        h, p = h.lower(), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or (len(h), len(p), v) > best[:3]:
                best = (len(h), len(p), v, h + p)
    return (host, path, best[3], best[2]) if best else (host, path, None, "allow")


def test_against_plain_search(spark, frame):
    rng = random.Random(1)
    hosts = ["org", "Example.org", "a.example.org", "xample.org", "com", "b.com", "", "a..b", "ex-ample.org"]
    paths = ["", "/", "/a", "/a/", "/ab", "/a/b/c", "/é", None]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(30)]
    rules += [(None, "/", "block"), ("com", "/", None), ("org", "/a", "allow"), ("org", "/a", "block")]
    urls = [None, "", "no scheme", "http://", "x://?q", "http://www.example.org", "http://a://b/c"]
    for _ in range(400):
        host = rng.choice(["www.", "", "x.y."]) + rng.choice(hosts)
        urls.append(f"http://{host}{rng.choice(['', '/', '/a', '/ab/c', '/a/b/c/d', '/é/x'])}{rng.choice(['', '?q=/', '#x'])}")
    urls += ["http://hot.example.org/a"] * 300 + [f"http://hot.example.org/{'long' * 300}/{k}" for k in range(100)]
    table = frame([(k, u, "r", "h", "m") for k, u in enumerate(urls)], PAGES)
    got = judge_urls(table, spark.createDataFrame(rules, RULES)).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id], rules), urls[r.page_id]


def test_empty_tables(spark, frame):
    pages = frame([(1, "http://a.org/", "", "", "")], PAGES)
    none = spark.createDataFrame([], RULES)
    assert [r.verdict for r in judge_urls(pages, none, default="block").collect()] == ["block"]
    assert judge_urls(frame([], PAGES), none).count() == 0


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), op3_url_filters, OP3_SQL, folder) is None


def test_plan_has_no_python(spark):
    plan = op3_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan
