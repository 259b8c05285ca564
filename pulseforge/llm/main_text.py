"""Main text of web pages: boosted trees over the nodes of the page's tree.

Every block and text run gets the log-odds that it holds article text. A page's
nodes are then chosen together: a node can only be in if its parent is, and the
choice with the largest sum of log-odds wins, so that no text is kept inside a
part that goes.

There are no labelled pages, so the trees learn from two kinds of examples. On a
bounded sample of the given pages that mark an article, a text run is article text
if it stands in an element named as an article and in none named as something else;
a page without such a mark says nothing and is left out. Layouts made in code (with
the parts that pages have: menus, notices, sidebars, comments and so on, under many
names) know which text is their article's, whatever it stands in: a named element,
one without a name or with any other, a table cell, or the body itself. A share of
both is shown with the article's names or all names taken away, under the same
labels, so that text density, place and siblings must decide there.
"""

from __future__ import annotations

import copy
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseforge.llm import boosting, dom
from pulseforge.llm.common import blocks, pick

#: Pages of the table that the trees learn from, at most about, and nodes of each.
FIT_PAGES = 150
FIT_NODES = 200
LAYOUTS = 300

#: Stands before each piece of article text of a layout, to tell its label.
_MARK = "\ue000"
_GONE = frozenset("head nav footer aside form dialog".split())
_NAMES = {name: i for i, name in enumerate(dom.FAMILIES)}
_GONE_NAMES = frozenset(_NAMES[n] for n in ("advert", "menu", "footer", "sidebar", "notice", "form", "comment", "share"))


def marked(page: dom.Page) -> np.ndarray:
    """1 for text runs, and elements around them, that are marked as an article."""
    n = len(page.tag)
    article, gone, label = [False] * n, [False] * n, np.zeros(n)
    for i in range(1, n):
        p, tag = page.parent[i], page.tag[i]
        names = dom.families(page.attrs[i]) if page.attrs[i] else set()
        head = (tag == "header" or _NAMES["header"] in names) and not article[p]
        gone[i] = gone[p] or tag in _GONE or bool(names & _GONE_NAMES) or head
        article[i] = article[p] or tag in ("article", "main") or (_NAMES["content"] in names and not names & _GONE_NAMES)
        if tag == dom.TEXT and article[i] and not gone[i]:
            at = i
            while at >= 0 and not label[at]:
                label[at] = 1
                at = page.parent[at]
    return label


def unnamed(page: dom.Page, label: np.ndarray, everything: bool) -> dom.Page:
    """The page without names, and plain elements for marks, of the article and what
    is around it; or of all elements."""
    bare = copy.copy(page)
    gone = [everything or bool(y) for y in label]
    bare.attrs = ["" if g else a for g, a in zip(gone, page.attrs)]
    bare.tag = ["div" if g and t in ("article", "main") else t for g, t in zip(gone, page.tag)]
    return bare


def layout(number: int) -> tuple[str, str]:
    """A page laid out by rule, and the same with ``_MARK`` before each piece of
    article text; each number gives another one. Odd numbers have containers of
    any name or none, even ones containers named as an article."""
    rng = random.Random(number)
    pick_one = lambda *options: rng.choice(options)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randrange(1, 10)))
    sentence = lambda: " ".join(word() for _ in range(rng.choice((1, 2, 5, 9, 17)))).capitalize() + pick_one(".", ".", "!", "?")

    most = pick_one(3, 9, 9)  # sentences: pages of short and of long texts

    def prose() -> str:
        return " ".join(sentence() for _ in range(rng.randrange(1, most)))

    def links() -> str:
        items = [f'<li><a href="#">{word()}</a></li>' for _ in range(rng.randrange(2, 9))]
        return f"<ul>{''.join(items)}</ul>" if rng.random() < 0.8 else "".join(f"<a>{word()}</a> " for _ in items)

    def of(kind: str, *more: str) -> str:
        """A name for a part: one of ``more``, or a word that speaks of it, alone or with another."""
        word_ = pick_one(*dom.FAMILIES[kind])
        return pick_one(*more, word_, word_, f"{word_}-{pick_one('box', 'wrap', 'area', 'list', 'inner', 'top')}", f"site-{word_}", f"{word_}s", f"main{word_.capitalize()}")

    def named(tag: str, kind: str, *names: str) -> tuple[str, str]:
        name = of(kind, *names)
        key = pick_one("class", "class", "id", "role")
        return (f"<{tag}>", f"</{tag}>") if tag not in ("div", "section") and rng.random() < 0.5 else (f'<{tag} {key}="{name}">', f"</{tag}>")

    def part(kind: str) -> str:
        if kind == "menu":
            a, b = named(pick_one("nav", "div", "div"), "menu", "menu", "nav", "main-menu", "navbar", "breadcrumb", "navigation-menu", "skip")
            return a + links() + b
        if kind == "header":
            a, b = named(pick_one("header", "div"), "header", "header", "masthead", "branding")
            return a + pick_one("", f"<h1>{word()}</h1>", f"<div>{sentence()}</div>", f"<p>{sentence()}</p>") + pick_one("", links()) + b
        if kind == "footer":
            a, b = named(pick_one("footer", "div"), "footer", "footer", "page-footer", "copyright", "legal")
            return a + pick_one(f"&copy; {sentence()}", f"<p>{prose()}</p>", links()) + b
        if kind == "sidebar":
            a, b = named(pick_one("aside", "aside", "div"), "sidebar", "sidebar", "related", "widget", "popular", "side")
            return a + pick_one("", f"<h3>{word()}</h3>") + pick_one(links(), f"<p>{prose()}</p>", f"<p>{prose()}</p><p>{prose()}</p>", sentence()) + b
        if kind == "notice":
            name = of("notice", "notice", "cookie-notice", "cookie", "consent", "alert", "popup", "gdpr", "newsletter", "paywall", "modal")
            return f'<{(t := pick_one("div", "section", "p"))} class="{name}">{pick_one(sentence(), f"<p>{prose()}</p>" if t != "p" else prose())}{pick_one("", "<button>Ok</button>")}</{t}>'
        if kind == "advert":
            name = of("advert", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "ad-slot", "adBox")
            return f'<{(t := pick_one("div", "section"))} {pick_one("class", "id")}="{name}">{pick_one(sentence(), f"<p>{prose()}</p>")}</{t}>'
        if kind == "form":
            inner = pick_one("", f"<p>{sentence()}</p>") + f"<label>{word()}</label><input>" + pick_one("", f"<textarea>{word()}</textarea>", f"<select><option>{word()}<option>{word()}</select>")
            return f'<form{pick_one("", " class=search", " id=login")}>{inner}<button>{word()}</button></form>'
        if kind == "comments":
            one = lambda: pick_one(f"<p>{prose()}</p>", f"<b>{word()}</b><p>{prose()}</p>", prose(), f"<p>{prose()}</p><p>{prose()}</p>")
            inner = "".join(pick_one(f'<div class="comment">{one()}</div>', f"<li>{one()}</li>", one()) for _ in range(rng.randrange(1, 8)))
            a, b = f'<{(t := pick_one("div", "section", "ol"))} {pick_one("class", "id")}="{of("comment", "comments", "comment-list", "comments-area", "disqus", "replies", "discussion")}">', f"</{t}>"
            return a + pick_one("", f"<h2>{word()}</h2>", f"<h3>{word()}</h3>") + inner + b
        if kind == "share":
            return f'<div class="{of("share", "share", "social", "share-buttons")}">{links()}</div>'
        raise ValueError(kind)

    def own(html: str) -> str:
        return re.sub(r"(^|>)(?=[^<])", rf"\1{_MARK}", html)

    def article() -> str:
        out = [own(pick_one(f"<h1>{sentence()}</h1>", f"<h1>{word()}</h1>", f"<header><h1>{sentence()}</h1></header>", f"<h2>{sentence()}</h2>", ""))]
        for _ in range(int(rng.randrange(0, 4) if rng.random() < 0.3 else rng.randrange(2, 20))):
            out.append(own(
                pick_one(*[f"<p>{prose()}</p>"] * 8, f"<p>{sentence()}</p>", f"<p><b>{prose()}<br>", f"<h2>{sentence()}</h2>", f"<ul><li>{sentence()}</li><li>{prose()}</li></ul>",
                         f"<blockquote><p>{prose()}</p></blockquote>", f"<table><tr><td>{word()}</td><td>{sentence()}</td></tr></table>", f"<div>{prose()}</div>", f"<pre>{prose()}</pre>",
                         f"<p>{prose()} <a href='#'>{sentence()}</a> {sentence()}</p>", f"<p>{sentence()} <a href='#'>{word()}</a>.</p>", f"<p>{word()} {word()} with <a href='#'>{word()} {word()}</a>.", f"<ul><li>{word()} {word()}<li>{word()} {word()}</ul>", f"<ol><li>{sentence()}</li></ol>", f"<figure><img><figcaption>{sentence()}</figcaption></figure>")
            ))
            if rng.random() < 0.12:
                out.append(part(pick_one("advert", "advert", "sidebar", "form", "share", "notice", "menu")))
        if rng.random() < 0.2:
            out.append(part("comments"))
        other = pick_one("body-text", "text", "copy", "read", "inner", "col-8", "left", "center", "td-block", "page-body", "fulltext", word(), word())
        a, b = pick_one(
            ("", ""), ("<div>", "</div>"), ("<div>", "</div>"), ("<section>", "</section>"), ("<div><div>", "</div></div>"), ("<table><tr><td>", "</td></tr></table>"),
            (f"<table><tr><td>{links()}</td><td>", "</td></tr></table>"), ("<center>", "</center>"), (f'<div id="{other}">', "</div>"), (f'<div class="{other}">', "</div>"),
            (f'<div class="row"><div class="{other}">', "</div></div>"), (f'<section class="{other}">', "</section>"), (f'<td class="{other}">', "</td>"),
        ) if number % 2 else pick_one(
            ("<article>", "</article>"), ("<article>", "</article>"), ('<article class="post">', "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
            ('<div class="article">', "</div>"), ('<div class="content">', "</div>"), ('<div id="post-12" class="entry">', "</div>"), ('<div id="main-content">', "</div>"),
            ('<section class="story">', "</section>"), ('<div class="article-body">', "</div>"), (f'<div class="{of("content")}">', "</div>"), (f'<section id="{of("content")}">', "</section>"),
        )
        return a + "".join(out) + b

    def both(html: str) -> tuple[str, str]:
        return html.replace(_MARK, ""), html

    if number % 12 in (0, 5):  # a fragment
        return both(pick_one(own(f"<article><p>{word()}</p></article>"), article(), article() + part("footer"), part("menu") + article(), own(prose()), part("comments"), own(f"<div><p>{prose()}</p></div>")))
    before = [part(k) for k in ("menu", "header", "notice", "advert", "sidebar", "form", "share") if rng.random() < 0.5]
    after = [part(k) for k in ("comments", "sidebar", "form", "advert", "share", "menu", "notice", "footer", "footer") if rng.random() < 0.45]
    rng.shuffle(before)
    rng.shuffle(after)
    body = "".join(before) + article() + "".join(after)
    if rng.random() < 0.4:
        body = f'<div class="{pick_one("wrapper", "page", "container")}">{body}</div>'
    head = f"<head><title>{sentence()}</title><style>p{{}}</style></head>" if rng.random() < 0.9 else ""
    return both(f"<!DOCTYPE html><html>{head}<body>{body}</body></html>")


def told(page: dom.Page) -> np.ndarray:
    """Labels of a layout from its marks: 1 for article text and elements around it."""
    label = np.zeros(len(page.tag))
    for i, text in enumerate(page.text):
        at = i if _MARK in text else -1
        while at >= 0 and not label[at]:
            label[at] = 1
            at = page.parent[at]
    return label


def _examples(page: dom.Page, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, len(page.tag))
    at = at[:: -(-len(at) // FIT_NODES) or 1]
    return dom.measure(page)[at], label[at]


def _made(number: int) -> tuple[np.ndarray, np.ndarray]:
    """Examples of a layout; a third have names taken away."""
    html, mark = layout(number)
    page, label = dom.Page(html), told(dom.Page(mark))
    return _examples(unnamed(page, label, number % 2 == 1) if number % 3 == 0 else page, label)


def fit(pages: DataFrame, bound: int = FIT_PAGES, layouts: int = LAYOUTS) -> boosting.Trees:
    """Fit on about ``bound`` pages (picked by a hash of their text; all, if fewer),
    ``FIT_NODES`` evenly spaced nodes of each at most, and on the layouts. Of the
    picked pages those that mark no article are left out."""
    rows = pages.where(F.col("html").isNotNull()).select("html")
    many = rows.count()
    if many > bound:
        rows = rows.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int((1 << 30) * bound / many))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, column in blocks(batches, "html"):
            for html in column.to_pylist():
                page = dom.Page(html)
                label = marked(page)
                if not label.any():
                    continue
                kind = zlib.crc32(html.encode("utf-8", "replace")) % 4
                for shown in [page] + [unnamed(page, label, kind == 0)] * (kind < 2):
                    x, y = _examples(shown, label)
                    yield pa.record_batch({"x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                x, y = _made(number)
                yield pa.record_batch({"x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

    spark = pages.sparkSession
    numbers = spark.range(0, 2 * layouts, 1, max(1, min(16, layouts // 8)))
    found = rows.mapInArrow(learn, "x binary, y binary").unionByName(numbers.mapInArrow(make, "x binary, y binary"))
    found = sorted((bytes(r["x"]), bytes(r["y"])) for r in found.collect())
    width = len(dom.FEATURES)
    x = np.concatenate([np.frombuffer(a, dtype=np.float32).reshape(-1, width) for a, _ in found])
    y = np.concatenate([np.frombuffer(b) for _, b in found])
    return boosting.fit(x, y, np.ones(len(y)), trees=80, rate=0.4)


def chosen(parent: list[int], odds: np.ndarray) -> np.ndarray:
    """The nodes of the best choice in which every node's parent is in as well."""
    n = len(parent)
    best = odds.astype(float).copy()
    for i in range(n - 1, 0, -1):
        best[parent[i]] += max(0.0, best[i])
    kept = np.zeros(n, dtype=bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[parent[i]] and best[i] > 0
    return kept


def extract(pages: DataFrame, trees: boosting.Trees) -> DataFrame:
    """All columns of ``pages`` but ``html``, with ``text`` and ``n_chars``.

    The text has one line per block in page order, each with its white space as
    single blanks and its character references decoded. A null or empty page, and
    one without article text, gives an empty text. Pages of any length are read
    whole, malformed ones as far as their markup tells; repeated rows repeat.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, column in blocks(batches, "html"):
            parsed = [dom.Page(html) for html in column.to_pylist()]
            measured = [dom.measure(p) for p in parsed]
            odds = np.split(m.score(np.concatenate(measured)), np.cumsum([len(x) for x in measured])[:-1])
            texts = ["\n".join(t for t, keep in zip(p.text, chosen(p.parent, o)) if keep and t) for p, o in zip(parsed, odds)]
            rest = [n for n in batch.schema.names if n != "html"]
            yield pa.record_batch([
                *[batch.column(batch.schema.get_field_index(n)) for n in rest], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
            ], names=[*rest, "text", "n_chars"])

    rest = [f for f in pages.schema.fields if f.name not in ("html", "text", "n_chars")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    rows = pages.select(*[F.col(f"`{f.name}`") for f in rest], "html")
    return rows.mapInArrow(read, f"{kinds}, text string, n_chars long" if kinds else "text string, n_chars long")


def op6_main_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = pick(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html")
    return extract(pages, fit(pages))
