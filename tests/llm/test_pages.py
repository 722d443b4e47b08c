"""Main text of pages: planted pages, site templates, and the whole table against a plain extraction."""

import html as references
import re
import time

import pytest
from pyspark.sql import functions as F

from riskrank.llm import pages, queries
from riskrank.llm.common import Workspace

SF = "/root/testdata/sf0.001"

CASES = [
    (None, ""),
    ("", ""),
    ("no tags at all &amp; two  words\n", "no tags at all & two words"),
    ("<article><p>A&nbsp;b <b>c</b>d<p>e<br>f</article>", "A b cd\ne f"),
    ("<nav>n</nav><header>h</header><main><h1>T</h1><p>x</p></main><footer>f</footer>", "T\nx"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>by me</footer></article>", "T\nx"),
    ("<article>a<article>a reader's comment</article><p>b</article>", "a\nb"),
    ("<article><p>a</p><section class='comments'><article><p>c</p></article></section></article>", "a"),
    ("<article><p>x</article><section id=comments><article>c</article></section>", "x"),
    ("<p>a<script>if (a < b) { '</p>' }</script>b<style>p > a {}</style><p>c<!-- <p>d</p> --><!-- never ended <p>e", "ab\nc"),
    ("<div class='cookie-notice'>We use</div><div class='post with-sidebar'><p>x</p></div><aside>y</aside>", "x"),
    ("<div class='nav-open'><article><p>x</p></article></div>", "x"),
    ("<div class=ad>buy</div><div role=navigation>n</div><p hidden>h</p><div style='display: none'>s</div><p>x</p>", "x"),
    ("<form><p>your name<input></form><p>x<button>press</button></p>", "x"),
    ("<table><tr><td>1<td>2<tr><td>3</table><ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "1\n2\n3\na\nb\nc\nd"),
    ("<p title='a > b'>x</p><p title=it's>y</p><p title=\"open>z</p>", "x\ny\nz"),
    ("&lt;p&gt; &#65;&#x42; &copy2024 &am &notit; &#xD800; &unknown;", "<p> AB ©2024 &am ¬it; � &unknown;"),
    ("<head><title>T</title></head><body><p>x", "x"),
    ("<P>Upper</P><DIV>case</DIV>", "Upper\ncase"),
    ("a < b and <3 <p>c</p", "a < b and <3\nc"),
    ("x</div></p></article>y", "x\ny"),
    ("<textarea><p>t</p></textarea><iframe><p>f</p></iframe><p>x", "x"),
    ("<p> wide space\t</p>", "wide space"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", *(F.lit("x").alias(n) for n in ("host", "text", "template", "article"))
    )


def texts(spark, rows, **options):
    return {r.page_id: r.text for r in pages.extract(table(spark, rows), Workspace(spark), **options).collect()}


def test_planted_pages(spark):
    rows = [(i, None if i % 2 else f"http://h{i}.net/", html) for i, (html, _) in enumerate(CASES)]
    rows += [(None, "http://h.net", "<p>no id"), (0, "http://h0.net/", "<p>same id")]
    got = pages.extract(table(spark, rows), Workspace(spark))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    assert len(found) == len(rows)
    for i, (html, want) in enumerate(CASES):
        assert want in [r.text for r in found if r.page_id == i], html
    assert all(r.n_chars == len(r.text) for r in found)
    assert pages.extract(table(spark, []), Workspace(spark)).count() == 0


def site(i, host="shop.example.net", body=None):
    """No article, no telling class: only recurrence shows what is template."""
    parts = f"<div class=x1><p>All goods</p><p>Prices</p></div><div class=x7><h2>Page {i}</h2><p>Own words of {i}.</p><p>House rule.</p></div>"
    return (i, f"http://{host}/{i}", f"<html><body>{body or parts}<div class=x9>© the shop <span>2024</span></div></body></html>")


def test_template_of_a_site(spark):
    got = texts(spark, [site(i) for i in range(30)])
    assert got == {i: f"Page {i}\nOwn words of {i}." for i in range(30)}
    # Too few pages to tell, and another host that has the same elements.
    rows = [site(i) for i in range(30)] + [site(100 + i, "few.example.net") for i in range(5)]
    got = texts(spark, rows)
    assert got[0] == "Page 0\nOwn words of 0."
    assert got[100] == "All goods\nPrices\nPage 100\nOwn words of 100.\nHouse rule.\n© the shop 2024"


def test_copies_are_no_template(spark):
    body = "<article><h1>One</h1><p>The same everywhere.</p></article>"
    rows = [site(i, body=f"<div>menu {i}</div>{body}") for i in range(50)] + [site(99, body="<article><p>Other.</p></article>")]
    got = texts(spark, rows)
    assert all(got[i] == "One\nThe same everywhere." for i in range(50)) and got[99] == "Other."


def test_template_within_articles(spark):
    line = "<p>Read more on our site.</p>"
    rows = [site(i, body=f"<article><p>Own {i}.</p>{line}{'<p>Half.</p>' if i % 2 else ''}</article>") for i in range(40)]
    got = texts(spark, rows)
    assert got[0] == "Own 0." and got[1] == "Own 1.\nHalf."


def test_long_and_hostile_pages():
    """Time in proportion to the length, whatever is left open."""
    n = 200_000
    for piece in ("<p>word ", "<div><p>word", "<b", "<a href='", '<a x="', "<!--", "</", "<!", "&", "<li>", "<script>", "</div>", "<td>", "=" , "<x ="):
        began = time.time()
        page = pages.Page(piece * (n // len(piece)) + "<p>end")
        pages.main_text(page, "")
        assert time.time() - began < 20, piece
    page = pages.Page("<article>" + "<p>some words here</p>" * 100_000 + "</article>")
    assert len(page.kept()) == 100_000


def plain(html):
    """The pages of the tables: paragraphs of the article, which is marked as such."""
    article = re.search(r"<article>(.*?)</article>", html, re.S).group(1)
    pieces = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", article))
    found = (" ".join(references.unescape(re.sub("<[^>]*>", "", p)).split()) for p in pieces)
    return "\n".join(p for p in found if p)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op12_site_templates(spark, f"/root/testdata/{sf}").collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert (got[r.page_id].url, got[r.page_id].text) == (r.url, plain(r.html))
