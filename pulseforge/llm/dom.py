"""A page as a tree of blocks and text runs, and what is measured of its nodes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np

TEXT = "#text"

#: Elements that break a line of text (fixed by HTML). All others, unknown ones
#: too, stand in a line.
BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup html legend li listing main menu nav ol p plaintext pre search section summary table tbody td tfoot th thead title tr ul xmp".split()
)
#: Elements without content (fixed by HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page: it is not shown, or is drawn, or is
#: what a control can be set to.
SILENT = frozenset("script style template svg object canvas audio video iframe noembed noframes noscript annotation textarea select datalist".split())
#: What the start of these elements ends although it is still open (fixed by HTML):
#: drawings end where a page's own elements begin, but inside these, and controls
#: where blocks begin.
LEAVES_SVG = BLOCK - {"title"} | frozenset("b big br code em embed font hr i img meta nobr ruby s small span strong strike sub sup tt u var".split())
STAYS_SVG = frozenset("foreignobject desc title".split())
#: What the start of an element ends, and what that does not reach beyond.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody"), ("table",)), "tfoot": (("tbody",), ("table",)),
    "body": (("head",), ()),
}

TAGS = (
    "html head title body article main section div p h1 h2 h3 h4 h5 h6 nav header footer aside form fieldset ul ol li dl table tr td "
    "blockquote pre figure figcaption address dialog details"
).split()
LANDMARKS = ("head", "article", "main", "nav", "header", "footer", "aside", "form", "dialog")
#: Hash buckets of the words in class, id and role.
WORDS = 64
#: Beginnings of such words by what they speak of: names of one meaning share a feature.
FAMILIES = {
    "advert": ("ad", "ads", "advert", "sponsor", "promo", "banner", "adsense", "adslot", "outbrain", "taboola"),
    "menu": ("nav", "menu", "breadcrumb", "toc", "pagination", "pager", "skip", "tabs", "topbar"),
    "header": ("header", "masthead", "logo", "branding"),
    "footer": ("footer", "foot", "copyright", "legal", "colophon"),
    "sidebar": ("sidebar", "side", "aside", "related", "widget", "recommend", "popular", "trending", "rail", "complementary"),
    "notice": ("notice", "cookie", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "overlay", "banner", "warning", "toast", "paywall", "privacy"),
    "form": ("form", "login", "signin", "signup", "search", "register", "contact", "poll"),
    "comment": ("comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "feedback"),
    "share": ("share", "social", "follow", "tweet"),
    "content": ("content", "article", "post", "entry", "story", "main", "prose"),
}
NAMES = WORDS + len(FAMILIES)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TAG = {t: i for i, t in enumerate(TAGS)}
_LANDMARK_BIT = {t: 1 << i for i, t in enumerate(LANDMARKS)}

NUMBERS = (
    "depth", "is_text", "own_chars", "chars", "links", "runs", "blocks", "chars_per_block", "ends", "words_per_end", "index", "siblings",
    "share_of_parent", "alike", "sibling_chars", "place", "share_of_page", "longest", "paragraphs", "headings",
)
FEATURES = (
    *NUMBERS, *(f"tag_{t}" for t in TAGS), *(f"word_{k}" for k in range(WORDS)), *(f"attr_{f}" for f in FAMILIES),
    *(f"in_{t}" for t in LANDMARKS), *(f"in_word_{k}" for k in range(WORDS)), *(f"in_attr_{f}" for f in FAMILIES),
    "parent_main", "parent_text", "page_marked",
)


#: A comment, a tag (its slash, name and attributes), or another declaration. What
#: the page's end cuts off counts as closed there. No part of a match is given back
#: once taken, so that reading takes time in proportion to the page.
_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:"[^"]*+"?|'[^']*+'?)?)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.DOTALL
)
_NAMED = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*|'[^']*|[^\s"'>]+)""", re.IGNORECASE)
#: Elements whose content holds no tags, and those of them that are text (fixed by HTML).
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.IGNORECASE) for t in "script style textarea title xmp iframe noembed noframes".split()}
RAW_TEXT = frozenset(("title", "xmp"))


class Page:
    """Nodes in page order, parents first: ``tag``, ``parent``, ``depth``,
    ``attrs``; text runs are nodes with ``text`` and ``linked`` characters."""

    def __init__(self, html: str):
        self.tag, self.parent, self.depth, self.attrs = [], [], [], []
        self.text: list[str] = []
        self.linked: list[int] = []
        self._open: list[int] = []
        self._many: Counter[str] = Counter()  # open elements of a name
        self._silent: list[str] = []  # open elements of SILENT, and those of STAYS_SVG in drawings
        self._link = 0
        self._waiting: list[str] = []
        self._waiting_linked = 0
        self._add("#page", "")
        self._open.append(0)
        self._read(html)
        self._flush()

    def _read(self, html: str) -> None:
        at = 0
        while found := _MARKUP.search(html, at):
            self._data(html[at:found.start()])
            at = found.end()
            slash, tag, attrs = found.groups()
            if not tag:
                continue
            tag = tag.lower()
            if slash:
                self._end(tag)
                continue
            drawn = "svg" in self._silent
            self._start(tag, attrs)
            if tag in RAW and not (drawn and (tag == "title" or attrs.endswith("/"))):
                end = RAW[tag].search(html, at)
                stop = end.start() if end else len(html)
                if tag in RAW_TEXT:
                    self._data(html[at:stop])
                at = stop
        self._data(html[at:])

    def _add(self, tag: str, attrs: str, text: str = "", linked: int = 0) -> None:
        self.tag.append(tag)
        self.parent.append(self._open[-1] if self._open else -1)
        self.depth.append(len(self._open))
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)

    def _flush(self) -> None:
        text = " ".join("".join(self._waiting).split())
        if text:
            self._add(TEXT, "", text, min(self._waiting_linked, len(text)))
        self._waiting, self._waiting_linked = [], 0

    def _close(self, tags: tuple[str, ...], beyond: tuple[str, ...] = ()) -> None:
        if not any(self._many[t] for t in tags):
            return
        for at in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[at]]
            if tag in tags:
                self._flush()
                for node in self._open[at:]:
                    self._many[self.tag[node]] -= 1
                del self._open[at:]
                return
            if tag in beyond:
                return

    def _still_silent(self, tag: str) -> bool:
        """Whether an open silent element goes on at the start of another."""
        kind = self._silent[-1]
        if kind == "svg" and tag in LEAVES_SVG or kind in ("select", "datalist") and tag in BLOCK:
            while self._silent and self._silent[-1] in ("svg", "select", "datalist"):
                self._silent.pop()
        return bool(self._silent)

    def _start(self, tag: str, attrs: str) -> None:
        if self._silent and self._still_silent(tag):
            drawn = "svg" in self._silent
            if (tag in SILENT or drawn and tag in STAYS_SVG) and not (attrs.endswith("/") and (drawn or tag not in RAW)):
                self._silent.append(tag)
        elif tag in VOID:
            if tag == "br":
                self._waiting.append(" ")
            elif tag == "hr":
                self._flush()
        elif tag in SILENT:
            if tag in RAW or tag != "svg" or not attrs.endswith("/"):
                self._silent.append(tag)
        elif tag == "a":
            self._link += 1
        elif tag in BLOCK:
            self._flush()
            self._close(("p",), ("table", "td", "th"))
            if tag in ENDS:
                self._close(*ENDS[tag])
            self._link = 0
            self._add(tag, " ".join(unescape(v.lstrip("\"'")) for v in _NAMED.findall(attrs)) if attrs else "")
            self._open.append(len(self.tag) - 1)
            self._many[tag] += 1

    def _end(self, tag: str) -> None:
        if self._silent:
            if tag in self._silent:
                while self._silent.pop() != tag:
                    pass
                return
            # The end of a block around an element that was left open ends both.
            if tag not in BLOCK or not self._many[tag] or "template" in self._silent:
                return
            self._silent.clear()
        if tag == "a":
            self._link = max(0, self._link - 1)
        elif tag == "p" and not self._many["p"]:
            self._flush()
        elif tag in BLOCK:
            self._close((tag,))

    def _data(self, data: str) -> None:
        if data and not self._silent:
            data = unescape(data) if "&" in data else data
            self._waiting.append(data)
            if self._link:
                self._waiting_linked += len(data.strip())


@lru_cache(maxsize=10_000)
def families(attrs: str) -> frozenset[int]:
    """The families that the words of class, id and role speak of; a longer
    beginning also stands for the words it begins."""
    words = [w.lower() for w in _NAME.findall(attrs)]
    return frozenset(i for i, starts in enumerate(FAMILIES.values()) for w in words for s in starts if w == s or w == s + "s" or (len(s) > 4 and w.startswith(s)))


@lru_cache(maxsize=10_000)
def words(attrs: str) -> int:
    """The words of class, id and role as bits: their hash buckets, then what they
    speak of."""
    mask = sum(1 << WORDS + f for f in families(attrs))
    for word in _NAME.findall(attrs):
        mask |= 1 << zlib.crc32(word.lower().encode()) % WORDS
    return mask


def measure(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` per node. Nodes stand in page order, so a subtree
    is a stretch of nodes and its sums are differences of running sums."""
    n, parent, tags = len(page.tag), page.parent, page.tag
    own = [len(t) for t in page.text]
    size, longest, index, siblings, alike = [1] * n, own[:], [0] * n, [0] * n, {}
    over, inside, own_words = [0] * n, [0] * n, [0] * n  # bits: landmarks above, words above, own words
    for i in range(1, n):
        p, tag = parent[i], tags[i]
        index[i] = siblings[p]
        siblings[p] += 1
        alike[p, tag] = alike.get((p, tag), 0) + 1
        if page.attrs[i]:
            own_words[i] = words(page.attrs[i])
        over[i] = over[p] | _LANDMARK_BIT.get(tags[p], 0)
        inside[i] = inside[p] | own_words[p]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        size[p] += size[i]
        if longest[i] > longest[p]:
            longest[p] = longest[i]

    up = np.maximum(np.array(parent), 0)
    stop = np.arange(n) + np.array(size)
    is_text = np.array([t == TEXT for t in tags])

    def below(values: list | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.append(0, np.cumsum(np.asarray(values, dtype=float)))
        return sums[stop] - sums[:n], sums[:n]

    chars, before = below(own)
    links, ends = below(page.linked)[0], below([t.count(".") + t.count("!") + t.count("?") for t in page.text])[0]
    runs, blocks = below(is_text)[0], below(~is_text)[0] - ~is_text
    paragraphs, headings = below([t == "p" for t in tags])[0], below([t in ("h1", "h2", "h3") for t in tags])[0]
    beside = np.array(siblings)[up]
    same = np.array([0, *[alike[parent[i], tags[i]] - 1 for i in range(1, n)]])
    total = max(1.0, chars[0])
    numbers = (
        page.depth, is_text, np.log1p(own), np.log1p(chars), links / np.maximum(1, chars), np.log1p(runs), np.log1p(blocks),
        np.log1p(chars / (1 + blocks)), np.log1p(ends), np.log1p(chars / (6 * (1 + ends))), np.minimum(index, 50), np.minimum(beside, 50),
        chars / np.maximum(1, chars[up]), same / np.maximum(1, beside - 1), np.log1p((chars[up] - chars) / np.maximum(1, beside - 1)),
        before / total, chars / total, np.log1p(longest), np.log1p(paragraphs), np.log1p(headings),
    )
    tag = np.array([_TAG.get(t, -1) for t in tags])
    # Characters of the page in elements that are marked as an article.
    main = _LANDMARK_BIT["article"] | _LANDMARK_BIT["main"]
    content = 1 << WORDS + list(FAMILIES).index("content")
    marked = sum(k for k, a, b in zip(own, over, inside) if a & main or b & content)

    def bits(masks: list[int], k: int) -> np.ndarray:
        size = -(-k // 8)
        raw = np.frombuffer(b"".join(m.to_bytes(size, "little") for m in masks), dtype=np.uint8).reshape(n, size)
        return np.unpackbits(raw, axis=1, bitorder="little")[:, :k]

    return np.column_stack([
        *numbers, tag[:, None] == np.arange(len(TAGS)), bits(own_words, NAMES), bits(over, len(LANDMARKS)), bits(inside, NAMES),
        np.isin(tag[up], (_TAG["article"], _TAG["main"])), chars[up] / total, np.full(n, marked / total),
    ]).astype(np.float32)
