import pytest

from orderlens.llm import html_extract as he

TEXT = "The article has some words of its own."


@pytest.mark.parametrize(("html", "text"), [
    ('<article><p>one<svg class="i"/> two</p><p>three</p></article>', "one two three"),
    ('<article><p>one<svg/> two<iframe src="x"/> three<object data="x"/> four<math/> five</p></article>', "one two three four five"),
    ("<article><p>one<svg><path d='x'/><text>drawn</text></svg> two</p></article>", "one two"),
    ("<article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn><mspace/></math> holds</p><object data=x><p>kept</p></object><p>end</p></article>",
     "where x=2 holds kept end"),
])
def test_empty_and_embedded_elements_lose_no_text(html, text):
    assert he.main_text(html, []) == text


@pytest.mark.parametrize("name", ["content no-sidebar", "article-with-comments", "entry has-header", "related-work", "comments", "share-price"])
def test_the_wrapper_of_the_text_is_kept_whatever_its_name(name):
    html = f"<body><div class='{name}'><p>{TEXT}</p></div><div class='sidebar'><p>side</p></div><nav>{TEXT * 9}</nav></body>"
    assert he.main_text(html, []) == TEXT


@pytest.mark.parametrize(("name", "kept"), [
    ("related-work", True), ("no-comments", True), ("share-price", True), ("ad", False), ("ad-slot", False), ("x related-posts", False),
    ("site-footer", False), ("comments-list-2", False), ("left-sidebar", False),
])
def test_parts_are_skipped_by_whole_names(name, kept):
    html = f"<article><p>{TEXT}</p><div class='{name}'><p>part</p></div></article>"
    assert he.main_text(html, []) == (f"{TEXT} part" if kept else TEXT)


def test_many_named_elements_inside_one_another():
    assert he.main_text("<div class='ad'>" * 3000 + TEXT, []) == TEXT


@pytest.mark.parametrize(("html", "text"), [
    ('<article title="The hidden valley"><p>x y</p></article>', "x y"),
    ("<article title='a role=menu hidden'><p>x y</p></article>", "x y"),
    ('<article data-hidden="false"><p>x y</p></article>', "x y"),
    ('<div data-role="banner"><article><p>x y</p></article></div>', "x y"),
    ('<article><p>see <a title="hidden gems">the link text</a> here</p></article>', "see the link text here"),
    ('<article><p data-class="ad">x</p><p class="a" class="ad">y</p></article>', "x y"),
    ("<article><p hidden>x</p><p>y</p></article>", "y"),
    ('<article><p aria-hidden="true">x</p><p aria-hidden="false">y</p></article>', "y"),
    ('<div role="navigation">x</div><p>y</p>', "y"),
])
def test_attributes_are_whole_names(html, text):
    assert he.main_text(html, []) == text


def test_a_page_inside_one_form_is_kept_and_small_forms_go():
    form = f"<form action='x'><div><p>{TEXT * 3}</p><fieldset><p>{TEXT * 3}</p></fieldset></div></form>"
    assert TEXT in he.main_text(f"<html><body>{form}</body></html>", [])
    beside = f"<article><p>{TEXT}</p><form><p>Your name</p></form><fieldset>choose</fieldset></article>"
    assert he.main_text(beside, []) == TEXT


@pytest.mark.parametrize("part", ["<b>x ", "<div>", "<x-y>", "<p>x", "</x-y>", "<div>x</b>", "<a href=z>x "])
def test_a_page_of_a_megabyte_takes_linear_time(part):
    """Twice the page, about twice the time; one page of a megabyte is no problem."""
    import time

    spent = []
    for size in (250_000, 1_000_000):
        html = part * (size // len(part)) + "end"
        at = time.process_time()
        assert he.main_text(html, []).endswith("end")
        spent.append(time.process_time() - at)
    assert spent[1] < 12 * spent[0] + 1


def test_deep_pages_keep_short_paths():
    page = he.Page("<div class='some-name'>" * 8000 + "text")
    assert sum(len(x.path) for x in page.nodes) < 8001 * (he.PATH_CHARS + 1)
    assert he.Page("<div>" * 300).nodes[-1].path == he.Page("<div>" * 300).nodes[-1].path


def test_many_winning_paths_are_joined_with_salted_hosts(spark, monkeypatch):
    data = [(i, f"http://h{i % 3}.example/{i}", f"<body><div class='side'>long words {'y ' * (30 if i == 4 else 1)}</div><div class='art'>text text text {i}</div></body>")
            for i in range(60)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    want = sorted(map(tuple, he.extract(pages).collect()))
    monkeypatch.setattr(he, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, he.extract(pages).collect())) == want
