import html as escapes
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulseforge.llm import boosting, dom, main_text


@pytest.fixture(scope="module")
def trees(spark):
    return main_text.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def article(page):
    inside = page.partition("<article>")[2].partition("</article>")[0]
    parts = [" ".join(escapes.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>|(?=<p>)", inside)]
    return "\n".join(p for p in parts if p)


def test_pages_of_the_table(spark, trees):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    rows = main_text.extract(pages, trees).collect()
    assert len(rows) == len(html)
    assert all(r.text == article(html[r.page_id]) and r.n_chars == len(r.text) for r in rows)


HEAD = "<html><head><title>Never</title><style>p{}</style></head><body>"
PARTS = {
    "notice": '<div class="cookie-notice"><p>We use cookies on this site.</p></div>',
    "menu": '<div id="topMenu"><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></div>',
    "advert": '<div class="advertisement">Buy this now!</div>',
    "sidebar": '<aside><h3>Related</h3><p>Another story that is long enough to look like text. It goes on.</p></aside>',
    "form": "<form><label>Mail</label><input><button>Send</button></form>",
    "comments": '<section class="comments"><h2>Comments</h2><div class="comment"><p>I think so too. Thanks for this.</p></div></section>',
    "footer": "<footer><p>All rights reserved.</p></footer><script>document.write('<p>no</p>')</script>",
}
BLOCKS = ["<h1>A &amp; B</h1>", "<p>First  para\n with <a href='x'>a link</a>.", "<p>Second <b>bold<br>text</b></p>", "<ul><li>one thing<li>other thing</ul>", "<blockquote><p>Said so.</p></blockquote>"]
WANTED = "A & B\nFirst para with a link.\nSecond bold text\none thing\nother thing\nSaid so."


@pytest.mark.parametrize("opening", ["<article>", '<main class="x">', '<div class="post-content">', '<div id="article">'])
def test_parts_that_go(spark, trees, opening):
    close = f"</{re.match('<([a-z]+)', opening)[1]}>"
    pages = []
    for a, b in itertools.combinations(PARTS, 2):
        pages.append(HEAD + PARTS[a] + opening + "".join(BLOCKS) + close + PARTS[b])
        pages.append(HEAD + opening + "".join(BLOCKS[:2]) + PARTS[a] + "".join(BLOCKS[2:]) + close + PARTS[b] + "</body></html>")
    rows = main_text.extract(spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "page_id long, html string"), trees).collect()
    right = sum(r.text == WANTED for r in rows)
    assert right >= 0.9 * len(rows), [(r.page_id, r.text) for r in rows if r.text != WANTED][:3]


@pytest.mark.parametrize("opening, closing", [("<div>", "</div>"), ('<div id="body-text">', "</div>"), ("<table><tr><td>", "</td></tr></table>"), ("", ""), ('<section class="zqx">', "</section>")])
def test_articles_without_a_name(trees, opening, closing):
    wanted, kept, wrong = 0, 0, 0
    for a, b in itertools.combinations(PARTS, 2):
        page = dom.Page(HEAD + PARTS[a] + opening + "".join(BLOCKS) + closing + PARTS[b] + "</body></html>")
        texts = [t for t, k in zip(page.text, main_text.chosen(page.parent, trees.score(dom.measure(page)))) if k and t]
        right = sum(len(t) for t in texts if t in WANTED.split("\n"))
        assert right > 0
        wanted, kept, wrong = wanted + len(WANTED.replace("\n", "")), kept + right, wrong + sum(map(len, texts)) - right
    assert kept >= 0.75 * wanted and wrong <= 0.1 * wanted


def test_labels_without_marks(spark):
    # A page that marks no article is no example of a page without one.
    bare = spark.createDataFrame([(HEAD + "".join(BLOCKS),)] * 3, "html string")
    with_bare, without = main_text.fit(bare, layouts=3), main_text.fit(bare.where("false"), layouts=3)
    assert all((getattr(with_bare, n) == getattr(without, n)).all() for n in ("feature", "limit", "leaf"))
    for i in range(24):
        html, mark = main_text.layout(i)
        page, told = dom.Page(html), main_text.told(dom.Page(mark))
        assert page.tag == dom.Page(mark).tag and (i % 12 in (0, 5) or told.any())
        assert i % 2 == 0 or not main_text.marked(page).any() or i % 12 == 5


def test_messy_pages(spark, trees):
    pages = [None, "", "   ", "plain text", "<article><p>open", "<p>a<div>b</p></div>c</ul></article>", "<" * 500, "<article>" + "<div>" * 3000 + "deep", "<article><p>&#x1F600; &nosuch; &lt;b&gt;&#0;</p></article>", "<article><p>x</p></article>"]
    table = spark.createDataFrame([(i, f"u{i}", h, "k", 3) for i, h in enumerate(pages + pages[-1:])], "page_id long, url string, html string, tag string, n_chars int")
    rows = sorted(main_text.extract(table, trees).collect())
    assert len(rows) == 11 and [r.text for r in rows[:3]] == [""] * 3
    assert all(r.n_chars == len(r.text) and r.tag == "k" for r in rows) and rows[9].text == rows[10].text == "x"
    assert main_text.extract(table.where("false"), trees).count() == 0
    assert main_text.extract(table, main_text.fit(table.where("false"))).count() == 11


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 8), st.randoms())
def test_choice_is_the_best_consistent_one(n, rng):
    parent = [-1] + [rng.randrange(i) for i in range(1, n)]
    odds = np.array([rng.randrange(-9, 10) + 0.5 for _ in range(n)])
    options = [k for k in itertools.product([False, True], repeat=n) if k[0] and all(k[parent[i]] or not k[i] for i in range(1, n))]
    best = max(options, key=lambda k: odds[list(k)].sum())
    assert main_text.chosen(parent, odds).tolist() == list(best)


def test_trees_learn_an_interaction():
    x = np.random.default_rng(1).uniform(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    assert ((boosting.fit(x[:1500], y[:1500], np.ones(1500)).score(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_sums_over_subtrees():
    page = dom.Page("<body><div><p>ab <a>cde</a></p><p>f.</p></div><p>ghij</p></body>")
    rows = dom.measure(page)
    chars = np.expm1(rows[:, dom.FEATURES.index("chars")]).round().astype(int).tolist()
    assert [(t, c) for t, c in zip(page.tag, chars)] == [("#page", 12), ("body", 12), ("div", 8), ("p", 6), ("#text", 6), ("p", 2), ("#text", 2), ("p", 4), ("#text", 4)]


@pytest.mark.parametrize("html, text", [
    ("<p>a<!-- <p>x</p> -->b<br>c", ["ab c"]), ("<![if x]>a<![endif]>b<![foo[", ["ab"]), ("<script>'</p><p>no'</script>a", ["a"]), ("<SCRIPT>no", []),
    ("<title>a &amp; <b></title>c", ["a & <b>", "c"]), ("<p title='>'>a<P class=\"b>\">c", ["a", "c"]), ("a < b &lt; c", ["a < b < c"]), ("<li>a<li>b<ul><li>c</ul>d", ["a", "b", "c", "d"]),
    ("<td>a<p>b<td>c", ["a", "b", "c"]), ("<svg><text>no</text></svg>a<svg/>b", ["ab"]), ("<p>a</div></b>b", ["ab"]),
    # What HTML ends although it is open, what stands in a line, and what is no text.
    ("<p>a</p><svg><path d='x'><p>b</p><p>c", ["a", "b", "c"]), ("<p>see <svg><g><path/></g></svg> icon</p>", ["see icon"]), ("<svg><title>no</title><text>no</text></svg>a", ["a"]),
    ("<svg><title/><style/></svg>a", ["a"]), ("<svg><foreignObject><p>no</p></foreignObject><g></svg>a", ["a"]), ("<div><svg><g></div>a", ["a"]), ("<div>a<video>no</div>b", ["a", "b"]),
    ("<p>x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z</p>", ["x y=2 z"]), ("<p>a<math><mi>b</math>c<p>d", ["abc", "d"]),
    ("<p>a <picture><source><img></picture> <button>b</button> <x-y>c</x-y> <label>d</label></p>", ["a b c d"]),
    ("<p>a<select><option>no<option>no</select>b", ["ab"]), ("<select><option>no<p>a", ["a"]), ("<p>a<textarea><p>no</textarea>b", ["ab"]),
    ("<template><p>no</p></template>a", ["a"]), ("<p>a<noscript><img></noscript>b", ["ab"]), ("a</p>b", ["a", "b"]), ("<canvas>no</canvas><object><p>no</p></object>a", ["a"]),
])
def test_markup(html, text):
    assert [t for t in dom.Page(html).text if t] == text


@pytest.mark.parametrize("part", ["<", "<a ", "<!--", "</p", "&", "<div>", "<p class='", "<script>"])
def test_reading_takes_time_in_proportion(part):
    page = dom.Page(part * 30_000)
    assert len(dom.measure(page)) == len(page.tag)
