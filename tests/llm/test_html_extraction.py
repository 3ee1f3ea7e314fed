"""Main text of pages: pages with known articles, damaged markup, edges."""

import html
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tablewright.llm import html_tagpath
from tablewright.llm.common import documents
from tablewright.llm.html_tagpath import main_text
from tablewright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOREM = "It rained all day, and the river rose above its banks. Nobody had expected it; the town was asleep when the first houses were lost."
NOISE = [
    "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us, and more.</a></li></ul></nav>",
    "<header><h2>The Daily River</h2><p>All the news, every day, since 1871.</p></header>",
    f"<aside><p>{LOREM[:90]}</p></aside>",
    f'<div class="sidebar-left"><p>Popular: {LOREM}</p></div>',
    '<div id="cookie-notice"><p>We use cookies, as everyone does. Accept them, please.</p><button>Accept</button></div>',
    '<div class="ad">Buy two umbrellas, get one free. Only today!</div>',
    '<form action="/s"><label>Search this site</label><input name=q><select><option>All<option>News</select><textarea>your words</textarea></form>',
    "<script>if (a < b) { document.write('<p>not text</p>'); }</script><style>p > b { color: red }</style><noscript><p>Turn on scripts.</p></noscript>",
    f'<section class="comments"><h3>3 comments</h3><article class="comment"><p>{LOREM} I was there.</p></article><p>{LOREM * 4}</p></section>',
    '<p style="display: none">hidden words, not to be seen.</p><div hidden>more of them.</div><!-- and <p>commented</p> ones -->',
    "<footer>&copy; The Daily River, all rights reserved. <a href=/i>Imprint</a></footer>",
    '<div role="dialog"><p>Subscribe to our letter, it is free.</p></div>',
]
ARTICLE = (
    "<h1>Rain &amp; <i>flood</i></h1><p>" + LOREM + "</p><h2>The\n morning</h2><p>A <b>dark</b> <a href=/m>morning</a> it was,<br>cold&nbsp;too &lt;indeed&gt;. " + LOREM
    + "</p><ul><li>three bridges</li><li>forty houses, at least</li></ul><blockquote>We &#8220;saw&#8221; it come.</blockquote>"
    "<table><tr><td>Monday</td><td>12 mm</td></tr><tr><td>Tuesday</td><td>80 mm</td></tr></table><p>" + LOREM[:40] + "</p>"
)
WANT = "\n\n".join(
    ["Rain & flood", LOREM, "The morning", "A dark morning it was, cold too <indeed>. " + LOREM, "three bridges", "forty houses, at least", "We “saw” it come.", "Monday 12 mm", "Tuesday 80 mm", LOREM[:40]]
)


def page(before, article, after):
    return f"<!DOCTYPE html><html><head><title>Rain - The Daily River</title><meta charset=utf-8></head><body class='has-sidebar'>{before}{article}{after}</body></html>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><article class='post'>{}</article></main>", "<main>{}</main>", '<div class="page with-sidebar"><div><article>{}</article></div></div>'])
def test_articles_among_noise(wrap):
    rng = random.Random(9)
    for _ in range(30):
        before, after = rng.sample(NOISE, 4), rng.sample(NOISE, 5)
        assert main_text(page("".join(before), wrap.format(ARTICLE), "".join(after))) == WANT
    for i, noise in enumerate(NOISE):
        inside = ARTICLE.replace("<ul>", noise + "<ul>", 1)
        want = WANT.replace("three bridges", "The Daily River\n\nthree bridges", 1) if noise.startswith("<header>") else WANT
        assert main_text(page("", wrap.format(inside), "")) == want, i


def test_ratios_choose_where_nothing_is_named():
    links = "<div><ul>" + "".join(f"<li><a href=/{i}>A place to go, number {i}.</a></li>" for i in range(12)) + "</ul></div>"
    short = "<div><span>12 May</span></div><div>Share</div><div>Page 1</div>"
    text = "<div><h1>Rain and flood</h1>" + f"<p>{LOREM}</p>" * 3 + "<h2>Morning</h2><p>A short one.</p></div>"
    want = "\n\n".join(["Rain and flood", *[LOREM] * 3, "Morning", "A short one."])
    assert main_text(page(links + short, text, short + links)) == want
    assert main_text(page(links, "", links)) == ""
    assert main_text("only words, no markup") == "only words, no markup"


def test_damaged_markup():
    assert main_text("<article><p><b>one<br><p>two</b> more<p>three<div>four</article> five</p>") == "one\n\ntwo more\n\nthree\n\nfour"
    assert main_text("<ARTICLE><P>a < b, and c<d>e</P><p>x</article><p>after</p>") == "a < b, and ce\n\nx"
    assert main_text("<article><ul><li>a<li>b</ul><dl><dt>t<dd>u</dl></div></span><p title='>\"'>q</p><p x=\"") == "a\n\nb\n\nt\n\nu\n\nq"
    assert main_text("<article>a<script>while (1) {") == "a" and main_text("<article>a<!-- b") == "a"
    assert main_text("<article>&copy &amp &nosuch; &#0; &#x41;</article>") == "© & &nosuch; � A"


def test_long_pages_take_linear_time():
    hard = ["<div>" * 60_000 + "</b>" * 60_000, "<p><b>" * 40_000, "<a '" * 60_000, "<" * 200_000, "<!--" * 50_000, "<ul><li>" * 30_000 + "</li>" * 30_000, "&" * 200_000, "<div class=ad>" * 30_000 + "x"]
    for h in hard:
        begun = time.process_time()
        main_text("<p>words, here.</p>" + h)
        assert time.process_time() - begun < 8, h[:20]
    text = "word " * 400_000
    assert main_text(f"<article><p>{text}</p></article>") == text.strip()


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>a</p>"), (3, "w", "<article>b</article>"), (3, "w", "<article>b</article>"), (4, "x", "<nav>menu</nav>"), (5, "y", " \n ")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("text", "n_chars", "path"):
        frame = frame.withColumn(c, F.lit("clash"))
    got = html_tagpath.extracted(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(((r.page_id or 0), r.url or "", r.text, r.n_chars) for r in got.collect()) == [
        (0, "v", "a", 1), (1, "u", "", 0), (2, "", "", 0), (3, "w", "b", 1), (3, "w", "b", 1), (4, "x", "", 0), (5, "y", "", 0),
    ]
    assert html_tagpath.extracted(frame.where("false")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_against_article_elements(spark):
    """The given pages hold one article element of a heading and paragraphs."""
    pages = {r.page_id: r.html for r in documents(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in QUERIES["op13_html_extraction"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    for i, h in pages.items():
        inner = re.search(r"<article>(.*)</article>", h, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[i].text == "\n\n".join(b for b in blocks if b) and got[i].n_chars == len(got[i].text)
