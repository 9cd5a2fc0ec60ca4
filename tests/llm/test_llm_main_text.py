"""Main text of pages: whole articles out of the given pages, and pages made for each rule."""

import html
import re
import time

import pytest

from reviewlake.llm.main_text import extract, inherited, main_text

PROSE = "The house on the hill was old, and it is said that the owner of the house left in the night."
PLAIN = "Ironwork masonry timber slates mortar chimneys gables rafters joists plaster lath panelling"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body>{body}</body></html>"


def test_given_pages(spark):
    """The article's lines, cut out by its tags, as the pages are all made alike."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    assert len(got) == pages.count()
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", row.html, re.S)[1]
        inner = re.sub(r"</?b>|<br>|</article|<[^>]*\Z", "", inner)
        lines = (" ".join(html.unescape(x).split()) for x in re.split(r"</?p>|</?h1>", inner))
        expected = "\n".join(x for x in lines if x)
        assert got[row.page_id].text == expected
        assert got[row.page_id].n_chars == len(expected) and got[row.page_id].url == row.url


@pytest.mark.parametrize(
    "left_out",
    [
        f"<nav><p>{PROSE}</p></nav>",
        f"<header><h2>{PROSE}</h2></header>",
        f"<div class='side sidebar-left'><div><p>{PROSE}</p></div></div>",
        f"<div id=cookieNotice role=dialog>{PROSE}</div>",
        f"<section class='post-comments'><article><p>{PROSE}</p></article></section>",
        f"<form><p>{PROSE}</p><button>Go</button></form>",
        f"<script>var x = '<p>{PROSE}</p>';</script><style>{PROSE}</style><noscript>{PROSE}</noscript>",
        f"<!-- <p>{PROSE}</p> --><div hidden>{PROSE}</div><div style='display: none'>{PROSE}</div>",
        f"<ul><li><a href=/a>{PROSE}</a></li><li><a href=/b>More of the same</a></li></ul>",
        f"<p class=advert>{PROSE}",
        f"<footer>&copy; {PROSE}</footer>",
    ],
)
def test_left_out(left_out):
    body = f"<p>{PROSE}</p><p>Short.</p><p>{PROSE} Again.</p>"
    expected = f"{PROSE}\nShort.\n{PROSE} Again."
    assert main_text(page(f"{left_out}<article>{body}</article>{left_out}")) == expected
    assert main_text(page(f"{left_out}<div class='has-sidebar entry'>{body}</div>{left_out}")) == expected
    if "<header" not in left_out:  # that of a region may hold its title
        assert main_text(page(f"<main>{body}{left_out}</main>")) == expected


def test_undecided_blocks_inherit():
    linked = "<p><a href=/x>Home and the way to all of it</a></p>"
    got = main_text(page(f"{linked}<p>Near the links</p><p>x</p><h2>Head</h2><p>{PROSE}</p><p>{PLAIN}</p>{linked}"))
    assert got == f"x\nHead\n{PROSE}\n{PLAIN}"
    assert inherited([None, False, None, None, True, None], False) == [False, False, False, True, True, True]
    assert inherited([None, False, None, True], True) == [True, False, True, True]
    assert inherited([None, None], False) == [True, True]
    assert inherited([], False) == inherited([], True) == []


def test_articles_first():
    beside = f"<div><p>{PROSE}</p></div>"
    assert main_text(page(f"{beside}<article><p>Be.</p><p>{PROSE}</p></article>{beside}")) == f"Be.\n{PROSE}"
    # A short article among nothing but left-out parts; one that holds nothing of its own.
    assert main_text(page("<nav>Menu</nav><article><h1>Be</h1><p>Be.</p></article><footer>End</footer>")) == "Be\nBe."
    assert main_text(page(f"<article class=teaser><p>{PROSE}</p></article><p>{PROSE} Main.</p>")) == f"{PROSE} Main."
    two = f"<article><p>{PROSE}</p></article><div>and</div><article><p>Two</p></article>"
    assert main_text(page(two)) == f"{PROSE}\nTwo"


def test_text_of_a_block():
    got = main_text("<article><p> a&nbsp;\n\t b&amp;amp; &eacute;<b>x</b>&lt;p&gt; &bogus; &#8364;<br>c<br><br>d<td>e</article>")
    assert got == "a b&amp; éx<p> &bogus; € c\nd\ne"
    assert main_text("<article><p title='a > b'>x <p>y<pre>z\n  z</pre><img alt='q'/>w &am") == "x\ny\nz z\nw &am"
    assert main_text("<article>1 < 2 and 3 <4 & 5</article>") == "1 < 2 and 3 <4 & 5"
    assert main_text("<article>cut<p class='x") == "cut"
    assert main_text("<article>a<script>b") == "a"
    assert main_text("<article>a<!-- b") == "a"
    assert main_text("") == ""


def test_time_in_proportion_to_length():
    started = time.time()
    for odd in ("<div>", "</div>", "<a ", '<a "', "<p>x", "<!--", "<", "<b>x</b>", "</p><ul>", "<br>", "&am"):
        assert main_text("<article>" + odd * 30_000) is not None
    assert time.time() - started < 20


def test_table(spark):
    rows = [(1, None, "t", 1), (None, "", "t", 2), (2, "<p>one</p>", None, 3), (2, "<p>one</p>", None, 3)]
    df = spark.createDataFrame(rows, "page_id long, html string, Text string, _page int")
    got = extract(df)
    assert got.columns == ["page_id", "html", "_page", "text", "n_chars"]
    assert sorted((r._page, r.text, r.n_chars) for r in got.collect()) == [(1, "", 0), (2, "", 0), *[(3, "one", 3)] * 2]
    assert extract(df.limit(0)).count() == 0
