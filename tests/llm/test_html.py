"""Main text of pages."""

import html
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from kiln.llm.html_text import extract_pages, fit_pages, highest_run, main_text, parse

SF = "/root/testdata/sf0.01"


def _article(page):
    """The article of a test page, read off its markup."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", inner))
    return "\n\n".join(p for p in parts if p)


def test_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in extract_pages(pages, fit_pages(pages)).collect():
        assert r.text == _article(r.html)


def test_boilerplate_goes_without_an_article_element():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>My site</header><div id="top-menu"><a href=1>home</a></div>
    <div class="cookie-notice">We use cookies on this site</div>
    <div id="content"><h1>A &amp; B</h1><p>First  paragraph
    of <b>the</b> text&hellip;<br>goes on.<p>Second one.<ul><li>point one<li>point two</ul>
    <form>Your name <input></form><div class="ad">Buy this now</div><p>Last words.</div>
    <aside>Other stories of the day</aside><section class="comments"><p>I liked this text a lot, thank you</p></section>
    <footer>&copy; us</footer><script>var x = "<p>no</p>"</script></body></html>"""
    assert main_text(page) == "A & B\n\nFirst paragraph of the text… goes on.\n\nSecond one.\n\npoint one\n\npoint two\n\nLast words."


def test_classes_that_describe_the_page_are_no_boilerplate():
    page = """<body class="home has-sidebar"><div class="layout with-sidebar"><header class="site-header">Our site</header>
    <article class="post"><header class="entry-header"><h1>Title of it</h1></header><p>All of the text.</p>
    <div class="share-buttons">Share this</div></article><div class="sidebar"><p>Most read of all these days</p></div></div></body>"""
    assert main_text(page) == "Title of it\n\nAll of the text."
    assert main_text(page.replace("article", "div")) == "All of the text."


def test_odd_pages():
    assert main_text("") == main_text("<script>let x") == main_text("<!-- never closed") == main_text("<nav>only a menu</nav>") == ""
    assert main_text("plain text") == "plain text"
    assert main_text("<p>a < b and 1 <2</p>") == "a < b and 1 <2"
    assert main_text('<p title="a>b">q</p>') == main_text('<p title="a>q</p>') == "q"
    assert main_text("<p>x<b>y</b>z</p><p hidden>not seen</p><p style='display: none'>nor this</p>") == "xyz"
    words = " ".join(["word"] * 200_000)
    assert main_text(f"<article><p>{words}</p></article>") == words
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_messy_pages(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>some text of a page</p>", "x"), (None, "u", "<p>some text of a page</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for some in (pages, pages.limit(0)):
        got = extract_pages(some, fit_pages(some))
        assert got.columns == ["page_id", "url", "html", "text"] and got.count() == some.count()
    assert sorted(r.text for r in extract_pages(pages, fit_pages(pages)).collect()) == ["", "", "some text of a page", "some text of a page"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ap\"'=!- divx&;", max_size=60))
def test_any_markup_is_read_to_its_end(page):
    blocks, events, elements = parse(page)
    assert isinstance(main_text(page), str)


WORDS = "some words that make up the text of it at a length that counts"


def test_unclosed_elements_lose_no_paragraph():
    for name in ("button", "svg", "canvas", "noscript", "object", "template", "select", "textarea", "iframe"):
        page = f"<article><h1>Title</h1><p>First {WORDS}.</p><{name}>Play<p>Second {WORDS}.</p><p>Third <b>{WORDS}</b></article><footer>us</footer>"
        got = main_text(page).split("\n\n")
        assert got[:2] == ["Title", f"First {WORDS}."] and got[-2:] == [f"Second {WORDS}.", f"Third {WORDS}"], name
    many = "<textarea>" * 20_000 + f"<p>{WORDS}</p>"
    assert main_text(many) == WORDS


def test_elements_within_a_paragraph_keep_it_whole():
    page = (f"<article><p>Formula <math><mi>x</mi><mo>=</mo><mn>3</mn><annotation>x=3</annotation></math> holds. {WORDS}</p>"
            f"<p>Press <button class=b>Go</button> now <svg><text>pic</text></svg>or <script>var a = '<p>'</script>later {WORDS}</p>"
            f"<div class='highlight search'>{WORDS}</div><blockquote class='reply'>{WORDS}!</blockquote><div class='advert'>Buy</div></article>")
    assert main_text(page).split("\n\n") == [f"Formula x=3 holds. {WORDS}", f"Press now or later {WORDS}", WORDS, WORDS + "!"]


@given(st.lists(st.integers(-5, 5), max_size=40))
@settings(max_examples=200, deadline=None)
def test_the_scan_finds_the_highest_run(scores):
    run = highest_run(scores)
    best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
    assert (run is None) == (best <= 0)
    if run is not None:
        assert sum(scores[run[0]:run[1] + 1]) == best
