"""Main text of pages: boosted trees judge every block-level node, a decoder makes them agree.

The trees learn from pages laid out anew: the paragraphs of a bounded sample of pages
are put into random layouts with menus, adverts, notices, comments and the like around
and inside, so what is main text is known by construction.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boosting
from tidemark.llm.dom import Nodes, Page, parse
from tidemark.llm.sampling import bounded_sample

_MARK = "data-main"


def _words(rng: np.random.Generator, pool: list[str], least: int, most: int) -> str:
    return " ".join(pool[i] for i in rng.integers(len(pool), size=rng.integers(least, most + 1)))


def _named(rng: np.random.Generator, *choices):
    return choices[rng.integers(len(choices))]


def layout(title: str, paragraphs: list[str], pool: list[str], rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page with these paragraphs as main text in a random layout; per node whether it is main text."""
    labels: list[bool] = [False]
    out: list[str] = ["<!DOCTYPE html>"]
    #: Whether tags and classes tell what a node is, or are made up.
    telling = rng.random() < 0.55

    def made() -> str:
        """A holder that says nothing: unnamed, or with a class as style sheets are compiled to."""
        kind = rng.integers(4)
        if kind < 2:
            return _named(rng, "div", "div", "section") if kind else "div"
        letters = "".join(chr(97 + rng.integers(26)) for _ in range(rng.integers(1, 7)))
        return f"div {_named(rng, 'class', 'class', 'id')}={letters}{_named(rng, '-', '_', '')}{rng.integers(1, 4096):x}"

    def known(*names: str) -> str:
        return _named(rng, *names) if telling else made()

    def put(opening: str, text: str = "", main: bool = False) -> str:
        labels.append(main)
        out.append(f"<{opening}>{text}")
        return opening.split()[0]

    def end(name: str) -> None:
        out.append(f"</{name}>")

    def leaf(opening: str, text: str, main: bool = False) -> None:
        end(put(opening, text, main))

    def links(tag: str, least: int, most: int) -> None:
        name = put(tag)
        for _ in range(rng.integers(least, most + 1)):
            word = _words(rng, pool, 1, 3)
            leaf("li", f'<a href="/{escape(word)}">{escape(word)}</a>')
        end(name)

    def junk(kind: str) -> None:
        text = lambda a, b: escape(_words(rng, pool, a, b))
        if kind == "menu":
            name = put(_named(rng, "nav", 'div class="menu"', 'div id="navigation"', "nav class=top"))
            links(_named(rng, "ul", "ol"), 2, 8)
            end(name)
        elif kind == "header":
            name = put(_named(rng, "header", 'div class="header"', 'div id="masthead"'))
            leaf(_named(rng, "div class=logo", "p", "h2"), text(1, 8))
            end(name)
        elif kind == "footer":
            name = put(_named(rng, "footer", 'div class="footer"', 'div id="site-footer"'), "&copy; " + text(2, 40))
            if rng.random() < 0.5:
                leaf("p", text(2, 60))
            end(name)
        elif kind == "advert":
            leaf(_named(rng, 'div class="ad"', 'div class="advert banner"', 'aside class="sponsored"', 'p class="promo"'), text(2, 60))
        elif kind == "side":
            bare = not telling and rng.random() < 0.6
            name = put(made() if bare else _named(rng, "aside", 'div class="sidebar"', 'div class="related"'))
            leaf(_named(rng, "h3", "h2"), text(1, 6))
            if bare or rng.random() < 0.6:
                links("ul", 2, 6)
            else:
                leaf("p", text(5, 80))
            end(name)
        elif kind == "notice":
            name = put(_named(rng, 'div class="cookie-consent"', 'div class="notice"', 'div id="newsletter"', 'div role="alert"'))
            leaf("p", text(4, 40))
            end(name)
        elif kind == "form":
            name = put(_named(rng, "form", 'form class="search"', 'form id="login"'))
            leaf(_named(rng, "label", "p"), text(1, 10) + "<input>")
            leaf("button", text(1, 2))
            end(name)
        elif kind == "comment":
            name = put(_named(rng, 'div class="comments"', 'section id="comments"', 'div id="disqus_thread"', 'section class="replies"'))
            for _ in range(rng.integers(1, 5)):
                one = put(_named(rng, 'div class="comment"', "article class=comment", "li class=reply", "div"))
                leaf("p", text(3, 90))
                end(one)
            end(name)
        else:
            links('ul class="share"' if telling else "ul", 2, 5)

    def special(text: str) -> None:
        """Main text in a table, figure, list of terms, preformatted block or object."""
        parts = [escape(t) for t in text.split(". ")]
        kind = _named(rng, "table", "figure", "dl", "pre", "object")
        if kind == "table":
            tags = [put(_named(rng, "div", "div class=table"), main=True)] if rng.random() < 0.4 else []
            tags.append(put("table", main=True))
            linked = rng.random() < 0.3
            if rng.random() < 0.3:
                leaf("caption", escape(_words(rng, pool, 1, 6)), True)
            if rng.random() < 0.5:
                tags.append(put("tbody", main=True))
            wide = rng.integers(1, 5)
            for k in range(rng.integers(1, 6)):
                row = put("tr", main=True)
                for j in range(wide):
                    cell = parts[(k * wide + j) % len(parts)] if rng.random() < 0.3 else escape(_words(rng, pool, 1, 5))
                    if linked and rng.random() < 0.5:
                        cell = f'<a href="/x">{cell}</a>'
                    leaf("th" if k == 0 or (j == 0 and rng.random() < 0.2) else "td", cell, True)
                end(row)
            for tag in tags[::-1]:
                end(tag)
        elif kind == "figure":
            holder = put("figure", "<img src=a.png>", True)
            leaf("figcaption", escape(_words(rng, pool, 1, 25)), True)
            end(holder)
        elif kind == "dl":
            holder = put("dl", main=True)
            for part in parts:
                leaf("dt", escape(_words(rng, pool, 1, 4)), True)
                leaf("dd", part, True)
            end(holder)
        else:
            leaf(_named(rng, "pre", "pre class=code") if kind == "pre" else _named(rng, "object data=a", "svg", "canvas"), parts[0], True)

    # Some pages are fragments, without the outer tags.
    frame = ["html lang=" + _named(rng, "en", "de"), "body"] if rng.random() < 0.85 else []
    for opening in frame:
        put(opening)
        if opening != "body":
            head = put("head")
            leaf("title", escape(title))
            end(head)
    wrapped = put(known("div id=page", "div class=wrapper", "div")) if rng.random() < 0.5 else ""
    often = _named(rng, 0.1, 0.35, 0.6)
    for kind in ("notice", "header", "menu", "advert", "form", "side"):
        if rng.random() < often + 0.4 * (kind == "menu"):
            junk(kind)
    outer = put(known("main", "section", "div class=columns")) if rng.random() < 0.4 else ""
    region = ""
    if telling or rng.random() < 0.75:
        named = _named(rng, "article", "article", 'article class="post"', 'div class="content"', 'div class="entry"', 'div id="main"', "main")
        region = put(named if telling or rng.random() < 0.2 else made(), main=True)
    if rng.random() < 0.9:
        leaf(_named(rng, "h1", "h2"), escape(title), True)
    # Paragraphs in p, in holders that say nothing, or in one block with line breaks.
    style = "p" if telling and rng.random() < 0.75 else _named(rng, "p", "div", "made", "breaks")
    if style == "breaks" and region:
        out.append(_named(rng, "<br>", "<br><br>", "<br/>\n").join(map(escape, paragraphs)))
        paragraphs = []
    sub, rich = _named(rng, (0.05, 0.0), (0.2, 0.06), (0.35, 0.2))
    for i, text in enumerate(paragraphs):
        if rng.random() < often / 6:
            junk(_named(rng, "advert", "share", "notice", "side", "form"))
        kind = rng.random()
        if kind < 0.05:
            leaf("h2", escape(_words(rng, pool, 1, 6)), True)
        elif kind < sub:
            leaf(_named(rng, "h3", "h3", "h4", "h5", "h6"), escape(_words(rng, pool, 1, 6)), True)
        if rng.random() < rich:
            special(text)
        if kind > 0.95:
            holder = put(_named(rng, "ul", "ol"), main=True)
            for part in text.split(". "):
                leaf("li", escape(part), True)
            end(holder)
        elif kind > 0.9:
            holder = put(_named(rng, "blockquote", "div"), main=True)
            leaf("p", escape(text), True)
            end(holder)
        else:
            one = "p" if style in ("p", "breaks") else "div" if style == "div" else made()
            leaf(one, ("<b>" if i == 0 and kind < 0.3 else "") + escape(text), True)
    if rng.random() < 0.15:
        leaf("p", escape(_words(rng, pool, 1, 8)), True)
    if rng.random() < often / 2:
        junk(_named(rng, "comment", "share", "advert", "side"))
    if region:
        end(region)
    for kind in ("comment", "side", "share", "advert"):
        if rng.random() < often / 1.5:
            junk(kind)
    if outer:
        end(outer)
    if rng.random() < 0.3:
        junk("menu")
    if rng.random() < 0.8:
        junk("footer")
    if wrapped:
        end(wrapped)
    for opening in frame[::-1]:
        end(opening.split()[0])
    return "".join(out), labels


def fit_layouts(pages: list[str], layouts: int = 1000, seed: int = 5, **options) -> boosting.Trees:
    """Trees from ``layouts`` random layouts of the texts of ``pages``; without pages, of made-up words."""
    rng = np.random.default_rng(seed)
    texts = [t for p in pages for _, t in parse(p).blocks]
    pool = [w for t in texts for w in t.split()[:40]] or ["word", "text", "a"]
    texts = texts or [_words(rng, pool, 1, 60) for _ in range(50)]
    made: list[Page] = []
    labels: list[bool] = []
    for _ in range(layouts):
        many = rng.integers(1, _named(rng, 2, 4, 10, 25, 60))
        chosen = [texts[i] for i in rng.integers(len(texts), size=many)]
        if rng.random() < 0.1:
            # Pages of a line or two.
            chosen = [_words(rng, pool, 1, 9) for _ in range(rng.integers(1, 3))]
        html, marks = layout(_words(rng, pool, 1, 14), chosen, pool, rng)
        page = parse(html)
        if len(page.code) != len(marks):
            raise ValueError("a layout was not read as it was written")
        made.append(page)
        labels += marks
    options = {"trees": 40, "depth": 5, "rate": 0.5, "bins": 32, "least_weight": 0.5, **options}
    return boosting.fit(Nodes(made).features(), np.array(labels, dtype=float), **options)


def main_blocks(html: list[str], trees: boosting.Trees) -> list[list[str]]:
    """The blocks of main text of each page, in page order."""
    if not html:
        return []
    pages = [parse(h) for h in html]
    nodes = Nodes(pages)
    kept = nodes.decode(trees.predict(nodes.features()))
    return [[t for k, t in p.blocks if kept[first + k]] for p, first in zip(pages, nodes.first)]


def extract_main_text(
    pages: DataFrame,
    most_pages: int = 300,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    at_once: int = 200,
) -> DataFrame:
    """(id, url, text, n_chars) for every row of ``pages``: blocks of main text, two line feeds between.

    The whole page is read. White space in a block is one space; character references
    are decoded; scripts, styles, templates and comments of the markup are no text. A null or empty
    page, or one without main text, gives an empty text; ``n_chars`` counts code points.
    Rows that repeat are each extracted, ids and urls may be null. Columns of other
    names are ignored; an empty table gives no rows.

    The trees learn from at most ``most_pages`` pages, chosen by a hash of their id and
    page; no more than these are sent to the driver.
    """
    slim = pages.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html")
    )
    sample = sorted(r.html for r in bounded_sample(slim, F.struct("id", "html"), most_pages).select("html").collect())
    shared = pages.sparkSession.sparkContext.broadcast(fit_layouts(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), at_once):
                part = batch.slice(k, at_once)
                texts = ["\n\n".join(b) for b in main_blocks(part.column("html").to_pylist(), shared.value)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["id", "url", "text", "n_chars"],
                )

    kinds = dict(slim.dtypes)
    out = slim.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id, "url": url})
