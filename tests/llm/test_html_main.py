"""Reading broken markup, decoding without contradictions, and text known by construction."""

from __future__ import annotations

import html as lib
import itertools
import re

import numpy as np
import pytest

from tidemark.llm import html_main
from tidemark.llm.dom import Nodes, parse
from tidemark.llm.queries import op4_html_extraction

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


@pytest.mark.parametrize(
    "source,blocks",
    [
        ("", []),
        ("plain &amp; text", ["plain & text"]),
        ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
        ("<p><b>a<br>  b\n<p>c</b>", ["a b", "c"]),
        ("<ul><li>x<li>y<ul><li>z</ul></ul>", ["x", "y", "z"]),
        ("<script>var t='</p>';</script><style>p{}</style>t<!-- <p>no</p> -->u", ["tu"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("<a href='x>y'>z</a> <p title=\"</p>\">w", ["z", "w"]),
        ("a < b <p>&#233;&eacute;&nbsp;x", ["a < b", "éé x"]),
        ("</div></p>x<script>never closed", ["x"]),
        ("<!-- never closed", []),
    ],
)
def test_blocks(source, blocks):
    assert [t for _, t in parse(source).blocks] == blocks


@pytest.mark.parametrize(
    "source,blocks",
    [
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds", ["if x=1 holds"]),
        ("<p>a</p><object data=x>fallback</object><p>b", ["a", "fallback", "b"]),
        ("<p>a <svg><path d=z /></svg> b <noscript>c</noscript> d", ["a b c d"]),
        ("<svg/>a <canvas>b</canvas><p>c", ["a b", "c"]),
        ("<noscript>a<p>b</p></noscript><svg><text>c</text></svg>", ["a", "b", "c"]),
        ("<p>a</p><noscript>b<p>c", ["a", "b", "c"]),
        ("<p>a</p><object><div>b</div><svg>c<p>d", ["a", "b", "c", "d"]),
        ("<template>x</template><p>a</p><template><p>b", ["a", "b"]),
        ("<iframe src=x>a</iframe><p>b<iframe>", ["a", "b"]),
    ],
)
def test_no_text_of_other_tags_is_lost(source, blocks):
    assert [t for _, t in parse(source).blocks] == blocks


def test_decoder_finds_the_best_labels_without_contradictions():
    rng = np.random.default_rng(1)
    page = parse("<div><p>a</p><div><p>b</p><ul><li>c</li></ul></div></div><p>d</p>")
    nodes = Nodes([page])
    n = len(page.code)
    for _ in range(40):
        p = rng.random(n) * 0.98 + 0.01
        best, top = None, -np.inf
        for state in itertools.product((0, 1, 2), repeat=n):
            if state[0] == 2 or any(state[k] not in {0: (0, 1), 1: (1, 2), 2: (2,)}[state[page.parent[k]]] for k in range(1, n)):
                continue
            score = sum(np.log(p[k]) if s == 1 else np.log(1 - p[k]) for k, s in enumerate(state))
            if score > top + 1e-12:
                best, top = [s == 1 for s in state], score
        got = nodes.decode(p)
        assert sum(np.log(p[k]) if s else np.log(1 - p[k]) for k, s in enumerate(got)) == pytest.approx(top)
        assert list(got) == best


def test_pages_do_not_influence_each_other():
    pages = ["<div class=menu><a>x</a></div><article><p>long text here, yes.</p></article>", "", "<p>y"]
    whole = Nodes([parse(p) for p in pages]).features()
    alone = np.concatenate([Nodes([parse(p)]).features() for p in pages])
    assert whole == pytest.approx(alone)


def test_text_known_by_construction(spark, frame):
    rng = np.random.default_rng(8)
    pool = [f"word{k}" for k in range(300)]
    text = lambda n: " ".join(pool[i] for i in rng.integers(300, size=n)) + "."
    rows, want = [], {}
    for k in range(120):
        paragraphs = [text(rng.integers(3, 80)) for _ in range(rng.integers(1, 9))]
        source, labels = html_main.layout(text(4), paragraphs, pool, rng)
        page = parse(source)
        want[k] = "\n\n".join(t for node, t in page.blocks if labels[node])
        rows.append((k, "u", source, "", ""))
    rows += [(500, None, None, "", ""), (501, "u", "", "", ""), (None, None, "<article><p>" + "very long text, " * 60_000 + "</p></article>", "", ""), rows[3]]
    got = html_main.extract_main_text(frame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[500] == by_id[501] == ""
    right = sum(by_id[k] == want[k] for k in want)
    assert right >= 0.9 * len(want)
    assert html_main.extract_main_text(frame([], SCHEMA)).count() == 0


def test_subheadings_tables_and_figures_are_main_text():
    pool = [f"word{k}" for k in range(300)]
    trees = html_main.fit_layouts([f"<p>{' '.join(pool[i * n % 300] for i in range(n))}." for n in range(3, 80)])
    rng = np.random.default_rng(4)
    text = lambda a, b: " ".join(pool[i] for i in rng.integers(300, size=rng.integers(a, b + 1)))
    rich = {
        "table": lambda: "<table>" + "".join(f"<tr><th>{text(1, 3)}<td>{text(1, 3)}<td>{text(1, 3)}" for _ in range(rng.integers(2, 30))) + "</table>",
        "list": lambda: f"<h3>{text(1, 4)}</h3><ul>" + "".join(f"<li>{text(1, 5)}" for _ in range(5)) + "</ul>",
        "section": lambda: f"<h4>{text(1, 4)}</h4><p>{text(10, 60)}</p><h6>{text(1, 3)}</h6><p>{text(5, 30)}</p>",
        "terms": lambda: "<dl>" + "".join(f"<dt>{text(1, 3)}<dd>{text(1, 12)}" for _ in range(8)) + "</dl>",
        "pre": lambda: f"<pre><code>{text(5, 80)}</code></pre>",
        "figure": lambda: f"<figure><img><figcaption>{text(1, 15)}</figcaption></figure>",
        "object": lambda: f"<object>{text(1, 15)}</object>",
    }
    menu = "<ul>" + "".join(f"<li><a href=/{w}>{w}</a></li>" for w in pool[:6]) + "</ul>"
    for kind, make in rich.items():
        pages, want = [], []
        for k in range(60):
            inner = f"<h1>{text(2, 6)}</h1>" + "".join(f"<p>{text(10, 60)}.</p>" for _ in range(rng.integers(0, 4)))
            inner += "".join(make() for _ in range(rng.integers(1, 4)))
            region = ("article", "div class=content", "main", "div id=main")[k % 4]
            pages.append(
                f"<html><head><title>{text(2, 6)}</title></head><body><nav>{menu}</nav><{region}>{inner}</{region.split()[0]}>"
                f"<aside><h3>{text(1, 3)}</h3>{menu}</aside><footer>{text(3, 20)}</footer></body></html>"
            )
            want.append([t for _, t in parse(inner).blocks])
        got = html_main.main_blocks(pages, trees)
        assert sum(g == w for g, w in zip(got, want)) >= 58, kind


def test_query_against_the_articles(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{folder}/pages.parquet'").fetchall())
    got = op4_html_extraction(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = (re.sub(r"<[^>]*>", "", re.sub("<br>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner))
        blocks = (" ".join(lib.unescape(b).split()) for b in blocks)
        assert r.text == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize(
    "source,blocks",
    [
        ('<p title="it>lost <b>text</b> <a href="y">z</a></p><p>q', ["lost text z", "q"]),
        ('<p title="it>He said "hello" to</p>', ['He said "hello" to']),
        ("<p a='x>y' b=\"</p>\">w", ["w"]),
        ("<p title=>a</p><p x'y>b", ["a", "b"]),
        ("<a b <p>c", ["c"]),
        ("a <b c", ["a <b c"]),
        ("x <!bad y>z", ["x z"]),
    ],
)
def test_broken_quotes_and_tags(source, blocks):
    assert [t for _, t in parse(source).blocks] == blocks


@pytest.mark.parametrize("piece", ["<a b ", '<p title="x ', "<x ' ", "<script ", "<template>", "</", "<p a='", '<p x="y>', "<div>", "<ul><p>", "</ul><li>"])
def test_parsing_takes_time_in_proportion(piece):
    import time

    def seconds(n):
        start = time.perf_counter()
        Nodes([parse(piece * n)])
        return time.perf_counter() - start

    seconds(100)
    short, long = min(seconds(4000) for _ in range(3)), seconds(32000)
    assert long < 40 * short + 0.2


def strange_page(rng, pool):
    """A page made apart from ``layout``: no telling name on main text, junk by what it is; and its main blocks."""
    text = lambda a, b: " ".join(pool[i] for i in rng.integers(len(pool), size=rng.integers(a, b + 1)))
    name = lambda: rng.choice(["", " class=css-1x9", " class='a b-c'", " id=r7", " class=\"_3fQ\"", " data-v=1"])
    title, paragraphs = text(3, 8), [text(12, 70) + "." for _ in range(rng.integers(3, 9))]
    style = rng.choice(["p", "div", "br", "span"])
    if style == "br":
        inner, want = "<br><br>".join(paragraphs), [title, " ".join(paragraphs)]
    else:
        around = {"p": ("<p>", "</p>"), "div": (f"<div{name()}>", "</div>"), "span": ("<div><span>", "</span></div>")}[style]
        inner, want = "".join(around[0] + p + around[1] for p in paragraphs), [title, *paragraphs]
    main = f"<h1>{title}</h1>{inner}"
    where = rng.choice(["body", "div", "deep", "section"] if style != "br" else ["div", "deep", "section"])
    if where != "body":
        tag = "section" if where == "section" else "div"
        main = f"<{tag}{name()}>{main}</{tag}>"
    if where == "deep":
        main = f"<div{name()}><div{name()}>{main}</div></div>"
    word = lambda: pool[rng.integers(len(pool))]
    menu = "<ul>" + "".join(f"<li><a href=/{w}>{w}</a>" for w in (word() for _ in range(rng.integers(4, 9)))) + "</ul>"
    top = f"<div{name()}>{menu}</div>" if rng.random() < 0.7 else f"<nav>{menu}</nav>"
    side = f"<div{name()}><h3>{text(1, 3)}</h3>{menu}</div>" if rng.random() < 0.5 else ""
    form = f"<form><label>{text(1, 3)}</label><input><button>{word()}</button></form>" if rng.random() < 0.4 else ""
    foot = f"<footer>&copy; {text(2, 12)}</footer>" if rng.random() < 0.8 else ""
    return f"<html><head><title>{title}</title></head><body>{top}{form}{main}{side}{foot}</body></html>", want


def test_pages_without_telling_names():
    pool = [f"word{k}" for k in range(300)]
    trees = html_main.fit_layouts([f"<p>{' '.join(pool[i * n % 300] for i in range(n))}." for n in range(3, 80)])
    rng = np.random.default_rng(11)
    pages = [strange_page(rng, pool) for _ in range(400)]
    got = html_main.main_blocks([p for p, _ in pages], trees)
    assert sum(g == want for g, (_, want) in zip(got, pages)) >= 0.95 * len(pages)
    six = [" ".join(pool[k * 9 : k * 9 + 14]) + ", and more." for k in range(6)]
    for opening, closing, one in (("<body>", "", "<p>{}</p>"), ('<div class="c-9f">', "</div>", "<div>{}</div>"), ("<div id=content>", "</div>", "{}<br>"), ("<main>", "</main>", "<p>{}</p>")):
        page = f"{opening}<h1>A title here</h1>{''.join(one.format(p) for p in six)}{closing}"
        blocks = html_main.main_blocks([page], trees)[0]
        assert blocks == (["A title here", " ".join(six)] if "br" in one else ["A title here", *six]), opening
