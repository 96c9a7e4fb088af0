import re
from html import unescape

import pytest

from orderlens.llm import html_extract as he
from orderlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL

PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body class="page p{n}">
<header class="site-header"><h1>Site</h1><nav><a href="/">Home</a></nav></header>
<div id="sidebar"><p>side text that is rather long, longer than one would think, really</p></div>
<main><div class="notice">Cookies! We use them a lot.</div>
<div class="post-{n} story"><h2>Title &amp; {n}</h2><p>First <a href="x">link</a>ed
  para<p>Second&nbsp;para &lt;b&gt;<ul><li>one<li>two</ul>
<form><label>Name</label><input name="q"> search</form><script>if(a<b){{"</div>"}}</script>
<div class="ad-slot ad">buy</div></div>
<section class="comments"><p>{comment}</p></section></main>
<footer>&copy; foot</footer></body></html>"""
TEXT = "Title & {n} First linked para Second para <b> one two"


def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string")


def test_one_page():
    html = PAGE.format(n=3, comment="short")
    assert he.best_path(html) == "/html/body.p#.page/main/div.post-#.story"
    assert he.main_text(html, []) == TEXT.format(n=3)


def test_host_consensus_overrules_a_page(spark):
    """On one page an unmarked side container is longer than the article; the host's votes decide."""
    def page(n, aside):
        return f"<body><div class='left'><p>Article {n} text text text</p></div><div class='right'><p>{aside}</p></div></body>"
    data = [(n, "http://h.example/a", page(n, "x")) for n in range(9)] + [(9, "http://H.example:80/b", page(9, "long words " * 20))]
    out = {r.page_id: r.text for r in he.extract(pages(spark, data), min_share=0.2).collect()}
    assert out == {n: f"Article {n} text text text" for n in range(10)}
    other = he.extract(pages(spark, [(9, "http://other.example/", data[9][2])])).first()
    assert other.text == ("long words " * 20).strip()


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<", "<"), ("plain &amp; bare", "plain & bare"), ("<!-- open", ""), ("<script>x", ""),
    ("<p>a<p>b</div></b>", "a b"), ("<div><p>a<b>b</b>c<br>d</div>", "abc d"), ('<a href="x>y</a> z', "y z"),
    ("<nav>menu</nav><footer>f</footer>", ""), ("<article><p>a &#x41;&#66; &copy</article>", "a AB ©"),
    ("<article>" + "<b>" * 3000 + "deep" + "</article>", "deep"),
])
def test_odd_markup(html, text):
    assert he.main_text(html, []) == text


def test_odd_rows(spark):
    data = [(1, None, "<p>x</p>"), (None, "not a url", None), (2, "http://a/", ""), (2, "http://a/", ""), (3, None, None)]
    df = pages(spark, data).withColumnRenamed("page_id", "_host").selectExpr("*", "1 as path")
    out = he.extract(df, text_col="body")
    assert out.columns == [*df.columns, "body"]
    assert sorted(r.body for r in out.collect()) == ["", "", "", "", "x"]
    assert he.extract(pages(spark, data).limit(0)).count() == 0
    with pytest.raises(ValueError):
        he.extract(df, text_col="HTML")


def test_query_equals_a_pattern_made_for_its_pages(spark):
    """All pages of the table hold one article element, whose text a pattern can cut out."""
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    found = QUERIES["op9_html_extraction"](spark, SF_SMALL).collect()
    assert len(found) == len(html)
    for r in found:
        inner = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        want = " ".join(unescape(re.sub(r"</?(p|h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert (r.text, r.n_chars) == (want, len(want))
