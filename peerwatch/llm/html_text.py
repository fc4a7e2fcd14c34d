"""Operator 8: main text of web pages by a tree-structured model.

A page becomes a tree of its block elements.  Every node is content or not; the probability of a node depends on its parent (its
label and the kind of place it is), and what is seen at the node (kind of tag, words of class and id, length of its own text, share of links) depends on the
node.  Sum-product messages, once from the leaves up and once from the root down, give the exact probability of each node, and the
text of nodes above one half is the result.

All tables are counted from labelled pages.  The labels come from pages with an ``article`` element: what is inside is content,
but for menus, side bars, forms and footers in it.  Pages with one article are learned from as they are, tree, names and all.
To learn other page designs as well, the parts of these pages are set again in several layouts, with menus, side bars,
notices, forms, adverts and comments in and around the content, made of the texts that the page has outside its article.

Scale: at most ``SAMPLE`` pages, those with the smallest hash of the id, of at most ``SAMPLE_CHARS`` characters, come to the driver for
learning (documented bound); all pages are read whole, in one pass without a shuffle; time is linear in the page.

Defined results: null or empty html gives an empty text; without any page with an article, layouts of plain words are learned from; broken
markup is read on as browsers do (missing and surplus end tags, open tags at the end; an element without text to read that is never closed ends
with the block it stands in, an open ``svg`` or ``math`` at the next block); a script inside a block does not cut it; ties at one half are content;
other columns are not touched.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import table

SAMPLE, SAMPLE_CHARS = 200, 200_000
SMOOTH = 0.5
LABEL = "data-content"

#: Fixed values of the format: elements without content, with raw text, without any text to read, and in a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
UNREAD = frozenset("script style textarea title xmp noembed noframes iframe noscript template svg math canvas audio video object select option button datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr br img nobr".split()
)
CLOSES_ITSELF = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
NOT_IN_ARTICLE = frozenset("nav aside form footer".split())
STOPS_AT = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "table tr", "th": "table tr"}
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split()
)
KINDS = {
    **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), "heading"), **dict.fromkeys("ul ol dl menu".split(), "list"),
    **dict.fromkeys("li dt dd".split(), "item"), **dict.fromkeys("table tbody thead tfoot tr td th caption".split(), "table"),
    **dict.fromkeys("form fieldset dialog".split(), "form"), **dict.fromkeys("figure figcaption blockquote pre".split(), "figure"),
    **{t: t for t in "p div section article main nav header footer aside body html".split()},
}
HINTS = {
    "menu": "nav menu navbar breadcrumb breadcrumbs pagination pager toc navigation",
    "header": "header masthead topbar branding logo banner",
    "footer": "footer copyright colophon legal",
    "side": "sidebar aside widget related recommended popular trending share social tags promo rail secondary complementary",
    "notice": "cookie cookies consent notice gdpr popup modal alert newsletter subscribe signup paywall overlay",
    "advert": "ad ads advert adverts advertisement sponsor sponsored adsense promoted",
    "comment": "comment comments disqus reply replies respond discussion",
    "form": "form login search contact",
    "content": "article content post entry story main body text prose maincontent",
}
_HINT = {word: hint for hint, words in HINTS.items() for word in words.split()}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|(?![\"'\s])))*+)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|data-content)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "hint", "label", "chars", "linked")

    def __init__(self, tag: str, parent: int, hint: str, label: str | None):
        self.tag, self.parent, self.hint, self.label, self.chars, self.linked = tag, parent, hint, label, 0, 0


def _attributes(raw: str) -> tuple[str, str | None]:
    hints, label = [], None
    for m in _ATTRIBUTE.finditer(raw):
        value = m[2].strip("\"'")
        if m[1].lower() == LABEL:
            label = value
        else:
            hints += [_HINT[w] for x in _WORD.findall(value) if (w := x.lower()) in _HINT]
    # A name such as "post-comments" is about comments: what speaks against content comes first.
    return next((h for h in hints if h != "content"), hints[0] if hints else "none"), label


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements in page order, and runs of text with the number of their element."""
    nodes = [Node("html", -1, "none", None)]
    runs: list[tuple[int, str]] = []
    stack, pieces, links, unread = [0], [], 0, None
    inner: dict[str, int] = {}  # elements open inside the unread one
    at, end = 0, len(html)

    def flush():
        nonlocal pieces
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                runs.append((stack[-1], text))
                nodes[stack[-1]].chars += len(text)
            pieces = []

    def read(raw: str):
        text = entities.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if links:
            nodes[stack[-1]].linked += len(text.strip())

    def past(tag: str, at: int) -> int:
        """Where raw text ends."""
        close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
        return close.end() if close else end

    while at < end:
        m = _TAG.search(html, at)
        stop = m.start() if m else end
        if stop > at and not unread:
            read(html[at:stop])
        if not m:
            break
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        closing = bool(m[1])
        if unread:
            if closing and inner.get(tag):
                inner[tag] -= 1
                continue
            if closing and tag == unread:
                unread = None
                continue
            if not closing and tag in RAW:
                at = past(tag, at)
                continue
            # An end tag of a block around it, or a block in a drawing, ends an element that was never closed.
            around = closing and any(nodes[i].tag == tag for i in stack[1:])
            escapes = not closing and unread in ("svg", "math") and tag in CLOSES_P and not any(inner.values())
            if not (around or escapes):
                if not closing and tag not in VOID and tag not in CLOSES_ITSELF and tag != "p" and not m[3].endswith("/"):
                    inner[tag] = inner.get(tag, 0) + 1
                continue
            unread = None
        if not closing and tag in UNREAD:
            if tag in RAW:
                at = past(tag, at)
            elif not m[3].endswith("/"):
                unread, inner = tag, {}
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            if tag == "br":
                pieces.append(" ")
            continue
        flush()
        links = 0
        if closing:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if nodes[stack[d]].tag == tag), 0)
            if depth:
                del stack[depth:]
            continue
        if tag in CLOSES_P:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if nodes[stack[d]].tag == "p"), 0)
            if depth:
                del stack[depth:]
        if tag in CLOSES_ITSELF:
            shut, bar = CLOSES_ITSELF[tag].split(), STOPS_AT.get(tag, "").split()
            for d in range(len(stack) - 1, 0, -1):
                if nodes[stack[d]].tag in bar:
                    break
                if nodes[stack[d]].tag in shut:
                    del stack[d:]
                    break
        if tag in ("html", "head") or tag in VOID:
            continue
        hint, label = _attributes(m[3]) if m[3].strip() else ("none", None)
        nodes.append(Node(tag, stack[-1], hint, label))
        if not m[3].endswith("/"):
            stack.append(len(nodes) - 1)
    flush()
    return nodes, runs


def seen(node: Node) -> tuple[str, str, int, int]:
    """What the model sees at a node."""
    length = 0 if not node.chars else 1 if node.chars < 25 else 2 if node.chars < 100 else 3
    linked = 0 if not node.chars or not node.linked else 1 if 2 * node.linked < node.chars else 2
    return KINDS.get(node.tag, "other"), node.hint, length, linked


def place(node: Node) -> str:
    """What kind of place a parent is: the potentials of its children depend on it."""
    kind = KINDS.get(node.tag, "other")
    return kind if kind in ("nav", "header", "footer", "aside", "form") else node.hint if node.hint != "none" else "list" if kind in ("list", "item", "table") else "none"


class Model:
    """Counts: of (parent, child) labels for each kind of parent, and of what is seen under either label."""

    def __init__(self):
        self.steps: dict[str, np.ndarray] = {}
        self.views = [({}, {}) for _ in range(4)]
        self.total = [0, 0]
        self.odds_of = {}

    def learn(self, html: str) -> None:
        """Count a page that says itself what is content."""
        nodes, labels = parse(html)[0], []
        for node in nodes:
            above = labels[node.parent] if node.parent >= 0 else 0
            labels.append(above if node.label is None else int(node.label == "1"))
        self.count(nodes, labels)

    def learn_article(self, html: str) -> None:
        """Count a page as it is, if it has one article: that is its content, but for menus, side bars, forms and footers."""
        nodes, labels = parse(html)[0], []
        if sum(n.tag == "article" for n in nodes) != 1:
            return
        for node in nodes:
            above = labels[node.parent] if node.parent >= 0 else 0
            labels.append(0 if node.tag in NOT_IN_ARTICLE else 1 if node.tag == "article" else above)
        self.count(nodes, labels)

    def count(self, nodes: list[Node], labels: list[int]) -> None:
        for node, label in zip(nodes[1:], labels[1:], strict=True):
            self.steps.setdefault(place(nodes[node.parent]), np.full((2, 2), SMOOTH))[labels[node.parent], label] += 1
            self.total[label] += 1
            for view, value in zip(self.views, seen(node), strict=True):
                view[label][value] = view[label].get(value, 0) + 1

    def finish(self) -> Model:
        self.steps[""] = sum(self.steps.values())
        self.chances = {k: (s / s.sum(axis=1, keepdims=True)).ravel().tolist() for k, s in self.steps.items()}
        return self

    def odds(self, what: tuple) -> float:
        """Probability of what is seen at content over the same elsewhere."""
        if (known := self.odds_of.get(what)) is None:
            known = 1.0
            for view, value in zip(self.views, what, strict=True):
                no, yes = ((view[k].get(value, 0) + SMOOTH) / (self.total[k] + SMOOTH * (1 + len({*view[0], *view[1]}))) for k in (0, 1))
                # A value never seen in learning says nothing.
                known *= yes / no if value in view[0] or value in view[1] else 1.0
            known = self.odds_of[what] = min(max(known, 1e-9), 1e9)
        return known

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability of content of every node."""
        steps = [self.chances.get(place(n), self.chances[""]) for n in nodes]
        here = [self.odds(seen(n)) for n in nodes]
        here[0] = 1e-9  # the page as a whole is not content
        up = here.copy()  # odds of all that is seen at and below a node
        message = [1.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            p = nodes[i].parent
            s00, s01, s10, s11 = steps[p]
            message[i] = (s10 + s11 * up[i]) / (s00 + s01 * up[i])
            up[p] = min(max(up[p] * message[i], 1e-200), 1e200)
        belief = up.copy()
        for i in range(1, len(nodes)):
            s00, s01, s10, s11 = steps[nodes[i].parent]
            rest = min(max(belief[nodes[i].parent] / message[i], 1e-200), 1e200)  # the parent without this child
            belief[i] = up[i] * (s01 + s11 * rest) / (s00 + s10 * rest)
        return [b / (1 + b) for b in belief]

    def text(self, html: str) -> str:
        nodes, runs = parse(html)
        chance = self.marginals(nodes)
        return "\n".join(text for node, text in runs if chance[node] >= 0.5)


def _layouts(title: str, body: list[str], other: list[str]) -> Iterator[str]:
    """Labelled pages of several designs; ``other`` is text from outside the content."""
    e = entities.escape
    yes, no = f' {LABEL}="1"', f' {LABEL}="0"'
    line = lambda i: e(other[i % len(other)])
    paragraphs = [f"<p>{e(t)}</p>" for t in body]
    half = len(paragraphs) // 2
    links = "<ul>" + "".join(f'<li><a href="#">{e(w)}</a></li>' for w in " ".join(other).split()[:6]) + "</ul>"
    menu = f"<nav>{links}</nav>"
    points = f"<ul><li>{line(2)}</li><li>{line(8)}</li><li>{line(9)}</li></ul>"
    comments = "".join(f'<div class="comment"><p>{line(i)}</p></div>' for i in range(3))
    yield (
        f'<body>{menu}<div class="ad">{line(0)}</div><article{yes}><h1>{e(title)}</h1>{"".join(paragraphs)}</article><footer>{line(1)}</footer></body>'
    )
    yield (
        f'<body><header class="site-header"><div class="logo">{line(0)}</div>{menu}</header><div id="cookie-notice"><p>{line(1)}</p></div>'
        f'<div id="wrapper"><div class="post-content"{yes}><h1>{e(title)}</h1>{"".join(paragraphs[:half])}<div class="advert"{no}><p>{line(2)}</p></div>'
        f'{points}{"".join(paragraphs[half:])}</div><aside class="sidebar"><h3>{line(3)}</h3>{links}<p>{line(4)}</p></aside></div>'
        f'<section id="comments"><h2>{line(5)}</h2>{comments}</section><footer class="footer"><p>{line(6)}</p></footer></body>'
    )
    yield (
        f'<body><div class="topbar"><p>{line(0)}</p></div><div class="menu">{links}</div><main><article{yes}><h1>{e(title)}</h1>{"".join(paragraphs[:half])}'
        f'<aside class="related"{no}><h3>{line(1)}</h3>{links}</aside>{"".join(paragraphs[half:])}{points.replace("ul>", "ol>")}'
        f'<form class="newsletter"{no}><p>{line(4)}</p></form><div class="comments"{no}>{comments}</div></article></main>'
        f'<div class="cookie-banner"><p>{line(5)}</p></div><div class="footer"><p>{line(6)}</p></div></body>'
    )
    yield (
        f'<body>{menu}<div class="banner"><p>{line(0)}</p></div><div class="container"><div id="main-content"{yes}><h2>{e(title)}</h2><blockquote><p>{line(1)}</p></blockquote>'
        f'{"".join(f"<div>{e(t)}</div>" for t in body)}{points}<table><tr><td>{line(2)}</td><td>{line(3)}</td></tr></table></div><div class="widget"><p>{line(4)}</p></div></div>'
        f'<form action="/login"><p>{line(5)}</p></form><div class="sponsored"><p>{line(6)}</p></div><div id="disqus">{comments}</div><footer>{line(7)}</footer></body>'
    )
    yield (
        f'<body><header><p>{line(0)}</p>{menu}</header><article{yes}><header><h1>{e(title)}</h1></header>{"".join(paragraphs)}'
        f'<section><h2>{line(2)}</h2><p>{line(3)}</p></section><footer{no}><p>{line(4)}</p></footer></article><footer><p>{line(1)}</p></footer></body>'
    )


def _parts(html: str) -> tuple[str, list[str], list[str]] | None:
    """Title, paragraphs and other texts of a page with an article."""
    nodes, runs = parse(html)
    inside = []
    for node in nodes:
        inside.append(node.tag == "article" or node.parent >= 0 and inside[node.parent])
    body = [(nodes[i].tag, t) for i, t in runs if inside[i]]
    other = [t for i, t in runs if not inside[i]]
    if not body or not other:
        return None
    return body[0][1], [t for _, t in body[1:]] or [body[0][1]], other


def train(spark: SparkSession, pages: DataFrame, *, sample: int = SAMPLE) -> Model:
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    rows = rows.where(F.contains(F.col("html"), F.lit("<article")) & (F.length("html") <= SAMPLE_CHARS))
    # First the places in the order, then the pages: only those of the sample leave their tasks.
    place = ["page_id", F.xxhash64("page_id", F.lit("html")).alias("p"), F.xxhash64("html").alias("h")]
    first = rows.select(*place).orderBy("p", "page_id", "h").limit(sample)
    first = F.broadcast(first.select(F.col("p").alias("p1"), F.col("h").alias("h1")).distinct())
    chosen = rows.select(*place, "html").join(first, F.expr("p = p1 and h = h1"), "left_semi")
    picked = sorted(chosen.dropDuplicates(["p", "page_id", "h"]).select("p", "page_id", "h", "html").collect(), key=lambda r: (r.p, r.h))
    model, plain = Model(), ("Some title", ["A long line of plain words about something that happened. " * n for n in (1, 2, 4)], ["short words"])
    for r in picked:
        if parts := _parts(r.html):
            model.learn_article(r.html)
            for layout in _layouts(*parts):
                model.learn(layout)
    if not sum(model.total):
        for layout in _layouts(*plain):
            model.learn(layout)
    return model.finish()


def main_text(pages: DataFrame, model: Model) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.text(v.as_py() or "") for v in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return main_text(pages, train(spark, pages))
