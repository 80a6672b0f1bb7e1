"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Every node has features of its tag, of the words in its class, id and role and
in those of its ancestors, of the density of text, links and tags in its
subtree, its depth and its siblings.  Boosted trees give the probability that
its text belongs to the article.  Decoding chooses for the whole tree at once:
a subtree is taken whole, left out whole, or split among its children at a
cost, whatever is likelier; so no node can contradict its ancestors.

The trees are fitted on a bounded sample of the pages themselves
(``SAMPLE_PAGES``, by a hash of the id), labelled where their own markup names
the article and its surroundings, and on the same texts laid out anew by a
seeded generator with known surroundings: other containers, class names,
notices, adverts, forms, side columns and reader comments.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import common as C
from vitrine.llm.dom import Node, blocks, parse
from vitrine.llm.trees import Boosted

SAMPLE_PAGES = 250
LAYOUTS_PER_PAGE = 4
SPLIT_COST = 1.5

TAGS = ("body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "nav", "aside",
        "header", "footer", "form", "button", "label", "table", "tr", "td", "th", "blockquote", "pre", "figure",
        "figcaption", "span", "a", "dl", "dt", "dd", "input", "select", "textarea", "fieldset", "address", "details",
        "small", "menu", "dialog", "center")
_TAG = {t: i for i, t in enumerate(TAGS)}

#: Words in names of things around an article, by what they name; the generator draws from them.
AROUND = {
    "menu": "nav menu navbar navigation topnav mainmenu submenu breadcrumb breadcrumbs crumbs pagination pager toc skip tabs",
    "head": "header masthead topbar banner branding logo sitename hero toolbar",
    "foot": "footer bottom copyright legal colophon imprint sitemap credits",
    "side": "sidebar side aside rail widget widgets secondary column right left related recommended popular trending more "
            "tags archive categories also teaser readmore",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay disclaimer privacy warning message paywall",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner adbox adslot partner outbrain taboola",
    "form": "form newsletter subscribe signup login search register subscription contact feedback survey",
    "share": "share social sharing follow tweet buttons tools actions print",
    "comment": "comment comments reply replies respond discussion disqus thread feedback response responses",
}
INSIDE = ("content article post entry story body text main maincontent articlebody postbody entrycontent page "
          "single hentry primary copy prose richtext").split()
_GROUP = {w: i for i, words in enumerate(AROUND.values()) for w in words.split()}
_INSIDE = frozenset(INSIDE)
GROUPS = len(AROUND) + 1
FEATURES = len(TAGS) + 1 + 3 * GROUPS + 30


def _groups(tokens: list) -> list:
    out = [0.0] * GROUPS
    joined = "".join(tokens)
    for t in tokens:
        g = _GROUP.get(t)
        if g is None and t.endswith("s"):
            g = _GROUP.get(t[:-1])
        if g is not None:
            out[g] += 1
        elif t in _INSIDE:
            out[-1] += 1
    if joined in _INSIDE and not out[-1]:
        out[-1] = 1
    return out


def features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """One row per node, and the number of characters of its own text."""
    n = len(nodes)
    own = np.zeros(n)
    link = np.zeros(n)
    words = np.zeros(n)
    marks = np.zeros(n)
    place = np.zeros(n)
    kids = np.zeros(n)
    index = np.zeros(n)
    seen = 0
    parent = np.array([max(x.parent, 0) for x in nodes])
    for i, x in enumerate(nodes):
        place[i] = seen
        for item in x.items:
            if isinstance(item, int):
                index[item] = kids[i]
                kids[i] += 1
            else:
                s = item.strip()
                own[i] += len(s)
                words[i] += s.count(" ") + (1 if s else 0)
                marks[i] += s.count(".") + s.count(",") + s.count("!") + s.count("?") + s.count("。")
        seen += own[i]
        link[i] = x.link
    under, under_link, under_words, under_marks, tags = own.copy(), link.copy(), words.copy(), marks.copy(), np.ones(n)
    inputs = np.array([x.tag in ("input", "select", "textarea", "button") for x in nodes], float)
    paragraphs = np.array([x.tag == "p" for x in nodes], float) * (own > 0)
    longest = own.copy()
    high = np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        under[p] += under[i]
        under_link[p] += under_link[i]
        under_words[p] += under_words[i]
        under_marks[p] += under_marks[i]
        tags[p] += tags[i]
        inputs[p] += inputs[i]
        paragraphs[p] += paragraphs[i]
        longest[p] = max(longest[p], longest[i])
        high[p] = max(high[p], high[i] + 1)
    x = np.zeros((n, FEATURES), np.float32)
    groups = np.array([_groups(node.tokens) for node in nodes])
    base = len(TAGS) + 1
    above = np.zeros((n, GROUPS))
    tag_above = np.zeros((n, 8))
    named = ("nav", "aside", "header", "footer", "form", "article", "main", "li")
    same: dict = {}
    for i, node in enumerate(nodes):
        x[i, _TAG.get(node.tag, len(TAGS))] = 1
        if i:
            p = parent[i]
            above[i] = above[p] * 0.9 + groups[p]
            tag_above[i] = tag_above[p]
            if nodes[p].tag in named:
                tag_above[i, named.index(nodes[p].tag)] += 1
            same[(p, node.tag)] = same.get((p, node.tag), 0) + 1
    beneath = groups.copy()
    for i in range(n - 1, 0, -1):
        beneath[parent[i]] += beneath[i]
    x[:, base:base + GROUPS] = groups
    x[:, base + GROUPS:base + 2 * GROUPS] = above
    x[:, base + 2 * GROUPS:base + 3 * GROUPS] = (beneath - groups) / tags[:, None]
    total = max(under[0], 1.0)
    siblings = np.maximum(kids[parent], 1)
    share = under / np.maximum(under[parent], 1)
    columns = [
        np.log1p(own), np.log1p(under), under_link / np.maximum(under, 1), link / np.maximum(own, 1),
        under / tags, np.log1p(tags), under_words / np.maximum(under, 1), under_marks / np.maximum(under_words, 1),
        marks / np.maximum(words, 1), under / total, place / total, (place + under) / total,
        np.array([node.depth for node in nodes], float), kids, siblings, index / siblings, share,
        inputs, np.log1p(paragraphs), paragraphs / np.maximum(paragraphs[0], 1), np.log1p(longest), high]
    for j, c in enumerate(columns):
        x[:, base + 3 * GROUPS + j] = c
    x[:, base + 3 * GROUPS + len(columns):] = tag_above
    return x, own


def decode(nodes: list[Node], p: np.ndarray, own: np.ndarray) -> list[bool]:
    """The likeliest labelling in which subtrees are whole, left out, or split at a cost."""
    n = len(nodes)
    weight = np.where(own > 0, 1 + np.log1p(own), 0.25)
    yes = weight * np.log(np.clip(p, 1e-4, 1))
    no = weight * np.log(np.clip(1 - p, 1e-4, 1))
    whole, none = yes.copy(), no.copy()
    parts = np.where(own > 0, np.maximum(yes, no), 0.0)
    best = np.zeros(n)
    for i in range(n - 1, -1, -1):
        best[i] = max(whole[i], none[i], parts[i] - SPLIT_COST)
        if i:
            q = nodes[i].parent
            whole[q] += whole[i]
            none[q] += none[i]
            parts[q] += best[i]
    kept, state = [False] * n, [0] * n  # 0: to be chosen, 1: all of it, -1: none of it
    for i in range(n):
        s = state[nodes[i].parent] if i else 0
        if s == 0:
            if whole[i] >= best[i]:
                s = 1
            elif none[i] >= best[i]:
                s = -1
            else:
                kept[i] = bool(yes[i] > no[i])
        state[i] = s
        if s:
            kept[i] = s > 0
    return kept


def _own_labels(nodes: list[Node]) -> tuple[list, list]:
    """Labels by a page's own markup, where it has any: +1, -1 or 0 (says nothing)."""
    out = []
    for i, x in enumerate(nodes):
        s = out[x.parent] if i else 0
        if x.tag in ("article", "main") and s >= 0:
            s = 1
        elif x.tag in ("nav", "aside", "footer", "form", "button", "select") or (x.tag == "header" and s == 0):
            s = -1
        elif s == 1 and any(_GROUP.get(t) in (4, 5, 8) for t in x.tokens):
            s = -1
        out.append(s)
    if 1 in out:  # what lies outside of the article is not of it
        out = [s or -1 for s in out]
    return out, [1.0 if s else 0.0 for s in out]


class Layouts:
    """Pages with known article and surroundings, from given titles and paragraphs."""

    def __init__(self, seed: int, spare: list[str]):
        self.rng, self.spare = np.random.default_rng(seed), spare or ["text"]

    def one(self, of):
        return of[int(self.rng.integers(len(of)))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def few(self, low: int, high: int) -> str:
        words = self.one(self.spare).split()
        n = int(self.rng.integers(low, high + 1))
        a = int(self.rng.integers(0, max(len(words) - n, 0) + 1))
        return _escape(" ".join(words[a:a + n]))

    def name(self, kind: str) -> str:
        if self.chance(0.12):
            return self.code()
        word = self.one(AROUND[kind].split())
        if self.chance(0.4):
            word = self.one(("site", "page", "main", "top", "box", "block", "js", "block")) + self.one("-_ ") + word
        if self.chance(0.3):
            word += self.one(("-1", "-wrap", "-inner", " clearfix", "-box", "-container"))
        return f' {self.one(("class", "class", "id"))}="{word}"'

    def code(self) -> str:
        """A name that says nothing, as build tools make them."""
        letters = "".join(self.one("abcdefghijklmnopqrstuvwxyz") for _ in range(int(self.rng.integers(2, 7))))
        return f' {self.one(("class", "class", "id"))}="{letters}{int(self.rng.integers(0, 99)) if self.chance(0.5) else ""}"'

    def wrap(self, kind: str, tags: tuple, inner: str, named: float = 0.9) -> str:
        tag = self.one(tags)
        attrs = self.name(kind) if self.chance(named) else ""
        return f'<{tag}{attrs} data-gold="0">{inner}</{tag}>'

    def links(self, low: int, high: int, words: int = 3) -> str:
        n = int(self.rng.integers(low, high + 1))
        items = [f'<a href="/x{i}">{self.few(1, words)}</a>' for i in range(n)]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " ".join(items)

    def around(self, kind: str) -> str:
        if kind == "menu":
            return self.wrap(kind, ("nav", "div", "ul", "nav"), self.links(3, 9), 0.8)
        if kind == "head":
            inner = f"<a href='/'>{self.few(1, 3)}</a>" + (f"<p>{self.few(3, 9)}</p>" if self.chance(0.5) else "")
            return self.wrap(kind, ("header", "div", "header"), inner + (self.around("menu") if self.chance(0.5) else ""), 0.8)
        if kind == "foot":
            inner = f"<p>&copy; {self.few(2, 12)}</p>" if self.chance(0.6) else f"&copy; {self.few(2, 12)}"
            return self.wrap(kind, ("footer", "footer", "div"), inner + (self.links(2, 6) if self.chance(0.5) else ""), 0.8)
        if kind == "side":
            inner = "".join(f"<h3>{self.few(1, 4)}</h3>" + (self.links(2, 6, 8) if self.chance(0.7) else f"<p>{self.few(5, 30)}</p>")
                            for _ in range(int(self.rng.integers(1, 4))))
            return self.wrap(kind, ("aside", "div", "section", "aside"), inner)
        if kind == "notice":
            return self.wrap(kind, ("div", "section", "p", "div"), f"{self.few(6, 40)} <a href='/p'>{self.few(1, 2)}</a>"
                             + (f"<button>{self.few(1, 2)}</button>" if self.chance(0.6) else ""))
        if kind == "ad":
            return self.wrap(kind, ("div", "div", "aside", "ins", "p", "span"), self.few(3, 35) if self.chance(0.6)
                             else f"<a href='//ads'>{self.few(2, 15)}</a><p>{self.few(3, 20)}</p>", 0.97)
        if kind == "form":
            inner = f"<label>{self.few(1, 6)}</label><input type='text'><button>{self.few(1, 2)}</button>"
            return self.wrap(kind, ("form", "form", "div"), (f"<p>{self.few(5, 20)}</p>" if self.chance(0.5) else "") + (
                inner if self.chance(0.6) else f"<form>{inner}</form>"), 0.8)
        if kind == "share":
            return self.wrap(kind, ("div", "div", "section"), self.links(2, 5, 2))
        said = "".join(self.one((f'<li class="{self.one(("comment", "item", "reply", "c"))}"><b>{self.few(1, 2)}</b><p>{self.few(8, 90)}</p></li>',
                                 f'<div class="{self.one(("comment", "comment-body", "msg"))}"><p>{self.few(8, 90)}</p></div>',
                                 f"<p>{self.few(8, 90)}</p>")) for _ in range(int(self.rng.integers(1, 7))))
        return self.wrap("comment", ("section", "div", "ol", "div"), f"<h3>{self.few(1, 3)}</h3>" + said, 0.97)

    def body(self, title: str, paragraphs: list[str]) -> str:
        out = []
        if self.chance(0.12):  # one run of text, cut by line breaks only
            rest = self.one(("<br><br>", "<br>", "<br />\n<br />")).join(map(_escape, paragraphs))
            head = self.one(("<h1>{}</h1>", "<h2>{}</h2>", "<b>{}</b><br><br>")).format(_escape(title)) if title else ""
            return head + rest
        if title:
            head = f"<h1>{_escape(title)}</h1>"
            if self.chance(0.15):
                head = f"<header>{head}</header>"
            out.append(head)
        kind = self.one(("p", "p", "p", "div", "p"))
        for i, t in enumerate(paragraphs):
            t = _escape(t)
            words = t.split(" ")
            if self.chance(0.2) and len(words) > 4:
                k = int(self.rng.integers(1, len(words) - 1))
                words[k] = self.one(('<a href="/l">{}</a>', "<b>{}</b>", "<em>{}</em>", "<span>{}</span>")).format(words[k])
                t = " ".join(words)
            draw = self.rng.random()
            if len(words) < 12 and draw < 0.4:
                out.append(f"<h2>{t}</h2>")
            elif draw < 0.06:
                out.append(f"<ul><li>{t}</li></ul>")
            elif draw < 0.10:
                out.append(f"<blockquote><p>{t}</p></blockquote>")
            elif draw < 0.12:
                out.append(f"<pre>{t}</pre>")
            elif draw < 0.16:
                rows = [f"<tr><td>{t}</td></tr>", f"<tr><th>{self.few(1, 3)}</th><td>{t}</td></tr>",
                        f"<tr><td>{t}</td><td>{self.few(1, 8)}</td></tr>"]
                extra = "".join(f"<tr><td>{self.few(1, 4)}</td><td>{self.few(1, 6)}</td></tr>" for _ in range(int(self.rng.integers(0, 4))))
                out.append(f"<table>{self.one(rows)}{extra}</table>")
            elif draw < 0.18:
                out.append(f"<figure><figcaption>{t}</figcaption></figure>")
            elif draw < 0.22:
                out.append(f"<p><b>{t}<br>")
            else:
                out.append(f"<{kind}>{t}</{kind}>")
            if self.chance(0.06):
                out.append(self.around(self.one(("ad", "ad", "share", "form", "side", "notice"))))
        return "".join(out)

    def page(self, title: str, paragraphs: list[str]) -> str:
        inner = self.body(title, paragraphs)
        if self.chance(0.4):
            inner += self.around(self.one(("share", "side", "comment", "form")))
        bare = self.chance(0.2)  # the article's blocks stand among the page's own
        tag = "div" if bare else self.one(("article", "main", "div", "div", "section", "td", "div"))
        attrs = ""
        if self.chance(0.15):
            attrs = self.code()
        elif tag not in ("article", "main") and self.chance(0.75) or self.chance(0.3):
            word = self.one(INSIDE)
            if self.chance(0.3):
                word = self.one(("post-", "entry-", "article-", "story-", "main-", "page-", "single-")) + word
            attrs = f' {self.one(("class", "id"))}="{word}"'
        if bare:
            inner = _each_gold(inner)
        else:
            inner = f'<{tag}{attrs} data-gold="1">{inner}</{tag}>'
        if tag == "td":
            inner = f"<table><tr>{self.wrap('side', ('td',), self.links(3, 8)) if self.chance(0.6) else ''}{inner}</tr></table>"
        for _ in range(0 if bare else int(self.rng.integers(0, 3))):
            inner = self.one((f"<div>{inner}</div>", f'<div class="{self.one(("container", "wrapper", "row", "layout", "page"))}">{inner}</div>', inner))
        before = [k for k, p in (("notice", 0.3), ("head", 0.7), ("menu", 0.7), ("ad", 0.5), ("share", 0.1), ("form", 0.15)) if self.chance(p)]
        after = [k for k, p in (("side", 0.5), ("comment", 0.45), ("ad", 0.3), ("form", 0.25), ("notice", 0.2), ("foot", 0.8)) if self.chance(p)]
        if self.chance(0.2):
            before.append("side")
        if self.chance(0.5 if bare else 0.25):  # hardly anything around
            before, after = before[:1] if self.chance(0.4) else [], after[-1:] if self.chance(0.3) else []
        return ("<html><head><title>t</title></head><body>" + "".join(map(self.around, before)) + inner
                + "".join(map(self.around, after)) + "</body></html>")


def _each_gold(source: str) -> str:
    """Marks every block of a container's inside that is not marked yet as the article's; its bare text gets a block."""
    inside = parse(f'<div data-gold="1">{source}</div>')
    if any(isinstance(x, str) and x.strip() for x in inside[1].items):
        return f'<p data-gold="1">{source}</p>' if len(inside) == 2 else f'<div data-gold="1">{source}</div>'
    return re.sub(r"<(h1|h2|p|div|ul|blockquote|pre|table|figure|header)>", r'<\1 data-gold="1">', source)


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def _gold(nodes: list[Node]) -> list:
    out = []
    for i, x in enumerate(nodes):
        out.append(1.0 if x.gold == "1" else 0.0 if x.gold == "0" or not i else out[x.parent])
    return out


def _has_article(nodes: list[Node]) -> list:
    """Nodes that hold the article and more: they say nothing about themselves."""
    holds = [x.gold == "1" for x in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        if holds[i]:
            holds[nodes[i].parent] = True
    return holds


class Extractor:
    """Fitted trees; small enough to travel with every task."""

    def __init__(self, pages: list[str], seed: int = 11):
        xs, ys, ws = [], [], []

        def add(nodes, y, w):
            x, own = features(nodes)
            xs.append(x)
            ys.append(np.array(y, float))
            ws.append(np.array(w, float) * (0.3 + np.log1p(own)))

        texts = []
        for source in pages:
            nodes = parse(source)
            y, w = _own_labels(nodes)
            if 1 in y:
                add(nodes, [float(s > 0) for s in y], w)
                texts.append(blocks(nodes, [s > 0 for s in y]).split("\n"))
            elif any(w):
                add(nodes, [0.0] * len(y), w)
        if not texts:
            texts = [blocks(parse(p), [True] * len(parse(p))).split("\n") for p in pages] or [["a text"]]
        layouts = Layouts(seed, [" ".join(t) for t in texts])
        for t in texts:
            for _ in range(LAYOUTS_PER_PAGE):
                a = int(layouts.rng.integers(0, max(len(t) - 2, 1)))
                page = parse(layouts.page(t[0] if layouts.chance(0.8) else "", t[a:a + int(layouts.rng.integers(1, layouts.one((4, 14))))]))
                y, holds = _gold(page), _has_article(page)
                add(page, y, [0.0 if h and v == 0 else 1.0 for h, v in zip(holds, y)])
        self.trees = Boosted().fit(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))

    def texts(self, pages: list) -> list[str]:
        """Main text of every page; of null and empty ones, and of pages without an article, ''."""
        parsed = [parse(p) for p in pages]
        made = [features(nodes) for nodes in parsed]
        p = self.trees.predict(np.concatenate([x for x, _ in made])) if made else np.zeros(0)
        out, at = [], 0
        for nodes, (x, own) in zip(parsed, made):
            out.append(blocks(nodes, decode(nodes, p[at:at + len(nodes)], own)))
            at += len(nodes)
        return out


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Extractor:
    """Trees from the ``sample_pages`` pages with the least hashes of (page_id, url)."""
    order = F.xxhash64("page_id", "url")
    chosen = (pages.filter("html is not null").select(order.alias("h"), F.xxhash64("html").alias("g"))
              .orderBy("h", "g").limit(sample_pages))
    most = chosen.agg(F.max("h")).first()[0]
    if most is None:
        return Extractor([])
    rows = (pages.filter("html is not null").filter(order <= F.lit(most)).select(order.alias("h"), "html").distinct()
            .orderBy("h", "html").limit(sample_pages).collect())
    return Extractor([r.html for r in rows])


def extract(pages: DataFrame, extractor: Extractor) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    The text is the article's blocks in page order, joined by line ends, with
    references decoded and white space in a block made one space.  Null and
    empty pages give ''.  Repeated rows and null ids are rows like others;
    other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.pieces(batch, "html", 1 << 20):
                yield C.rows({"page_id": part.column("page_id"), "url": part.column("url"),
                              "text": pa.array(extractor.texts(part.column("html").to_pylist()), pa.string())})

    return (pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(run, "page_id bigint, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("bigint")))
