"""A page as block-level nodes with their texts, and numbers that describe each node."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np

TAGS = (
    "html", "body", "head", "title", "article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol",
    "li", "nav", "header", "footer", "aside", "form", "table", "tr", "td", "blockquote", "pre", "figure",
)
_CODE = {t: i for i, t in enumerate(TAGS)} | {
    "h4": TAGS.index("h3"), "h5": TAGS.index("h3"), "h6": TAGS.index("h3"), "th": TAGS.index("td"),
    "menu": TAGS.index("ul"), "center": TAGS.index("div"), "figcaption": TAGS.index("figure"),
}
_OTHER = len(TAGS)
_BLOCK = {*_CODE, "dl", "dt", "dd", "address", "fieldset", "details", "summary", "dialog", "button", "select",
          "option", "label", "textarea", "tbody", "thead", "tfoot", "caption", "iframe", "hgroup", "search",
          "noscript", "svg", "object", "canvas"}
#: Their insides are no text. The first two go on to the end of the page if nothing closes them.
_SILENT = {"script", "style", "template"}
_RAW = {"script", "style"}
#: Nodes where a block begins; within a block that has text they are inline.
_EITHER = {"iframe", "noscript", "svg", "object", "canvas"}
_VOID_BLOCK = {"hr"}
_CLOSES_P = _BLOCK - {"option", "label", "button", "select", "textarea", "tr", "td", "th", "tbody", "thead", "tfoot"} - _EITHER
_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
         "body": {"head", "title"}}
_STOP = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}, "tbody": {"table"}, "option": {"select"}}
#: What the words in class, id and role attributes say of a node.
GROUPS = {
    "advert": "ad ads adv advert advertisement banner promo promoted sponsor sponsored dfp adsense taboola outbrain",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination toc tabs",
    "header": "header masthead topbar logo",
    "footer": "footer foot bottom copyright colophon",
    "side": "sidebar side aside widget rail related recommended trending popular tags",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall",
    "form": "form search login contact input",
    "comment": "comment comments reply replies respond disqus discussion reviews",
    "share": "share sharing social follow",
    "main": "article content main post entry story body text page prose",
}
_GROUP = {w: 1 << i for i, ws in enumerate(GROUPS.values()) for w in ws.split()}
_OPENING = re.compile(r"<(?:!--|(/?)([A-Za-z][^\s/>]*)|[!?/])")
_STOPS_TAG = re.compile(r"""[>"']""")
_VALUE = re.compile(r"=\s*\Z")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def tag_end(html: str, at: int) -> int:
    """Where the ``>`` of a tag stands whose name ends at ``at``; -1 if there is none.

    A quoted value may hold ``>``. A quote that opens a value counts only if the next one
    closes it, as far as can be told: white space, ``/`` or ``>`` stand behind that one,
    and no ``=`` before it. Otherwise the tag ends at the first ``>``.
    """
    here = at
    while m := _STOPS_TAG.search(html, here):
        place = m.start()
        if m[0] == ">":
            return place
        here = place + 1
        if not _VALUE.search(html[max(at, place - 16) : place]):
            continue
        close = html.find(m[0], here)
        if close < 0 or html[close + 1 : close + 2].strip(" \t\n\r\f/>") or _VALUE.search(html[max(here, close - 16) : close]):
            return html.find(">", here)
        here = close + 1
    return -1


def next_tag(html: str, at: int) -> tuple[int, int, str | None, bool, str]:
    """(start, end, name, whether it closes, attributes) of the next tag from ``at``; without a name it is a comment or the like.

    Each character is looked at a bounded number of times, however the markup is broken:
    where no ``>`` follows, no tag does, and the rest is text.
    """
    m = _OPENING.search(html, at)
    if not m:
        return len(html), len(html), None, False, ""
    if m[0] == "<!--":
        close = html.find("-->", m.end())
        return m.start(), len(html) if close < 0 else close + 3, None, False, ""
    close = html.find(">", m.end()) if m[2] is None else tag_end(html, m.end())
    if close < 0:
        return len(html), len(html), None, False, ""
    return m.start(), close + 1, m[2], bool(m[1]), html[m.end() : close]


class Page:
    """Block-level nodes in page order: parents before children. Node 0 stands for the page."""

    __slots__ = ("code", "parent", "depth", "own", "link", "stops", "groups", "blocks")

    def __init__(self) -> None:
        self.code, self.parent, self.depth = [_OTHER], [-1], [0]
        self.own, self.link, self.stops, self.groups = [0], [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []


def parse(html: str) -> Page:
    """The nodes of a page. Inline tags leave no node; broken nesting is closed as browsers do."""
    page = Page()
    open_: list[tuple[str, int]] = [("", 0)]
    held: list[str] = []
    linked = links = 0
    # How many nodes of a name are open, and tags that nothing further down closes: so that
    # neither the open nodes nor the rest of the page are searched in vain again and again.
    opened: Counter[str] = Counter()
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if held:
            text = "".join(held)
            if "&" in text:
                text = unescape(text)
            text = " ".join(text.split())
            held.clear()
            if text:
                node = open_[-1][1]
                page.blocks.append((node, text))
                page.own[node] += len(text)
                page.link[node] += min(linked, len(text))
                page.stops[node] += text.count(",") + text.count(".")
        linked = 0

    def close_until(names: set[str], stop: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for k in range(len(open_) - 1, 0, -1):
            if open_[k][0] in names:
                flush()
                opened.subtract(n for n, _ in open_[k:])
                del open_[k:]
                return
            if open_[k][0] in stop:
                return

    at, end = 0, len(html)
    while at < end:
        start, behind, name, closes, attributes = next_tag(html, at)
        if start > at:
            held.append(html[at:start])
            if links:
                linked += start - at
        at = behind
        if name is None:
            continue
        name = name.lower()
        if closes:
            if name == "a":
                links = max(0, links - 1)
            elif name in _BLOCK and opened[name]:
                close_until({name}, set())
            elif name == "p":
                flush()
            continue
        if name == "a":
            links += 1
        elif name in ("br", "img", "wbr"):
            held.append(" ")
        elif name in _SILENT:
            if not attributes.endswith("/"):
                close = None if name in unclosed else re.compile(rf"</{name}\b", re.I).search(html, at)
                if not close:
                    unclosed.add(name)
                shut = html.find(">", close.end()) if close else -1
                at = shut + 1 if shut >= 0 else end if name in _RAW else at
        elif name in _EITHER and (attributes.endswith("/") or any(t.strip() for t in held)):
            continue
        elif name in _VOID_BLOCK:
            flush()
            close_until({"p"}, {"div", "td", "section", "article"})
        elif name in _BLOCK:
            flush()
            links = 0 if name != "li" and name in ("article", "section", "p", "nav", "footer") else links
            if name in _CLOSES_P:
                close_until({"p"}, {"div", "td", "section", "article", "main", "blockquote", "li", "button"})
            if name in _LIKE:
                close_until(_LIKE[name], _STOP.get(name, set()))
            groups = 0
            if attributes:
                for a, b, c in _NAMES.findall(attributes):
                    for word in _WORD.findall(_CAMEL.sub(" ", a or b or c)):
                        groups |= _GROUP.get(word.lower(), 0)
            parent = open_[-1][1]
            open_.append((name, len(page.code)))
            opened[name] += 1
            page.code.append(_CODE.get(name, _OTHER))
            page.parent.append(parent)
            page.depth.append(page.depth[parent] + 1)
            page.own.append(0)
            page.link.append(0)
            page.stops.append(0)
            page.groups.append(groups)
    flush()
    return page


class Nodes:
    """The nodes of many pages as arrays."""

    def __init__(self, pages: list[Page]) -> None:
        sizes = np.array([len(p.code) for p in pages], dtype=np.int64)
        self.first = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        gather = lambda f: np.array([x for p in pages for x in getattr(p, f)], dtype=np.int64)
        self.code, self.depth, self.own = gather("code"), gather("depth"), gather("own")
        self.link, self.stops, self.groups = gather("link"), gather("stops"), gather("groups")
        parent = gather("parent")
        self.parent = np.where(parent >= 0, parent + self.first[self.page], -1)
        by_depth = np.argsort(self.depth, kind="stable")
        self.levels = np.split(by_depth, np.cumsum(np.bincount(self.depth, minlength=1))[:-1])

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = values.astype(np.float64)
        for level in self.levels[:0:-1]:
            np.add.at(out, self.parent[level], out[level])
        return out

    def down(self, flags: np.ndarray) -> np.ndarray:
        """Bits of a node and all its ancestors."""
        out = flags.copy()
        for level in self.levels[1:]:
            out[level] |= out[self.parent[level]]
        return out

    def features(self) -> np.ndarray:
        n = len(self.code)
        ones = np.ones(n)
        text, linked, stops = self.up(self.own), self.up(self.link), self.up(self.stops)
        under = self.up(ones)
        paragraphs = self.up(self.code == _CODE["p"])
        headings = self.up((self.code >= _CODE["h1"]) & (self.code <= _CODE["h3"]))
        items = self.up(self.code == _CODE["li"])
        whole = text[self.first[self.page]]
        root = self.parent < 0
        parent = np.where(root, np.arange(n), self.parent)
        children = np.bincount(parent[~root], minlength=n)
        pair = np.where(root, -1 - np.arange(n), parent * (_OTHER + 1) + self.code)
        _, back, alike = np.unique(pair, return_inverse=True, return_counts=True)
        order = np.zeros(n)
        below = np.flatnonzero(self.parent >= 0)
        by = below[np.argsort(parent[below], kind="stable")]
        starts = np.r_[True, parent[by][1:] != parent[by][:-1]] if len(by) else np.zeros(0, bool)
        order[by] = np.arange(len(by)) - np.maximum.accumulate(np.where(starts, np.arange(len(by)), 0))
        siblings = np.where(root, 1, children[parent])
        others = (text[parent] - self.own[parent]) / siblings
        tags = self.down(1 << self.code)
        groups = self.down(self.groups)
        semantic = [_CODE[t] for t in ("article", "main", "nav", "header", "footer", "aside", "form", "head", "ul")]
        columns = [
            self.depth, np.log1p(text), np.log1p(self.own), linked / np.maximum(text, 1), text / under,
            text / np.maximum(whole, 1), stops / np.maximum(text, 1), np.log1p(under), paragraphs, headings, items,
            children, order, order / siblings, siblings, alike[back] / siblings, text / np.maximum(others, 1),
            linked[parent] / np.maximum(text[parent], 1), text[parent] / np.maximum(whole, 1), paragraphs[parent],
        ]
        columns += [self.code == c for c in range(_OTHER + 1)]
        columns += [(tags >> c) & 1 for c in semantic]
        columns += [(self.groups >> i) & 1 for i in range(len(GROUPS))]
        columns += [(groups >> i) & 1 for i in range(len(GROUPS))]
        return np.stack([np.asarray(c, dtype=np.float32) for c in columns], axis=1)

    def decode(self, p: np.ndarray) -> np.ndarray:
        """Which nodes are main text: the likeliest labels without contradictions on any path.

        Down from the root a path is outside, then inside, then excluded; what is excluded
        has nothing inside again. Outside and excluded nodes are not main text.
        """
        p = np.clip(p, 1e-6, 1 - 1e-6)
        yes, no = np.log(p), np.log(1 - p)
        outside, inside, excluded = no.copy(), yes.copy(), no.copy()
        for level in self.levels[:0:-1]:
            above = self.parent[level]
            np.add.at(outside, above, np.maximum(outside[level], inside[level]))
            np.add.at(inside, above, np.maximum(inside[level], excluded[level]))
            np.add.at(excluded, above, excluded[level])
        state = np.zeros(len(p), dtype=np.int8)
        state[self.levels[0]] = inside[self.levels[0]] > outside[self.levels[0]]
        for level in self.levels[1:]:
            above = state[self.parent[level]]
            state[level] = np.where(
                above == 0,
                inside[level] > outside[level],
                np.where((above == 1) & (inside[level] >= excluded[level]), 1, 2),
            )
        return state == 1
