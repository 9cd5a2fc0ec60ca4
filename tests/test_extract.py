"""Reading pages: structured data, the site's markup, common markup, next links."""

import json
import time

import pyarrow as pa
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from catalog import pages as catalog_pages
from reviewlake.functions import arrow, html as html_functions, jsonld
from reviewlake.functions.html import outline
from reviewlake.operators import extract as X
from reviewlake.schema import REVIEW_COLS

SITE = "https://es.trustpilot.com/review/x.es"
OTHER = "https://shop.example/opiniones"


def pages(spark, *html, url=SITE):
    rows = [(i, url, h) for i, h in enumerate(html)]
    return spark.createDataFrame(rows, "page_id int, url string, html string")


def found(df, *names):
    order = [c for c in ["page_id", "source_rank", "pos"] if c in df.columns]
    return [tuple(r) for r in df.orderBy(*order).select(*names).collect()]


def script(data, kind='type="application/ld+json"'):
    return f"<script {kind}>{data if isinstance(data, str) else json.dumps(data)}</script>"


# --- outline ------------------------------------------------------------------


OUTLINES = [
    ("<p>uno<p>dos", [("p", "uno"), ("p", "dos")]),
    ("<p><b>uno<br><p>dos</p>", [("p", "uno"), ("p", "dos")]),
    ("<p>uno<div>dos</div>tres", [("p", "uno")]),
    ("<p>a<span>b</p>c</span>", [("p", "a b")]),
    ("<p>a</b>c</p>", [("p", "a c")]),
    ("<h2>uno<p>dos</p></h2>", [("h2", "uno"), ("p", "dos")]),
    ("<p>a<script>var x='</p><p>';</script>b</p>", [("p", "a b")]),
    ("<p>a<!-- <p>x</p> -->b<style>p{}</style></p>", [("p", "a b")]),
    ("<p>x &amp; y &ntilde;&#241;&nbsp;&lt;b&gt; 1 < 2</p>", [("p", "x & y ññ\xa0<b> 1 < 2")]),
    ("<li><p>a<li><p>b", [("p", "a"), ("p", "b")]),
    ("<table><tr><td><p>a<td><p>b</table>c", [("p", "a"), ("p", "b")]),
    ("<P>Á</P><time/>x", [("p", "Á"), ("time", "")]),
    ("<div id=q><p>a</div>b", [("div", "a"), ("p", "a")]),
    ("", []),
    ("<", []),
    ("<p", []),
]


def test_outline(spark):
    doms = pages(spark, *[h for h, _ in OUTLINES]).select("page_id", outline(F.col("html")).alias("d"))
    for row in doms.collect():
        shown = [(n.tag, " ".join(row.d.pieces[n.p0 : n.p1])) for n in row.d.nodes]
        assert (OUTLINES[row.page_id][0], shown) == OUTLINES[row.page_id]


def test_deeply_nested_page(spark):
    deep = "<p>" + "<button>" + "<div>" * 200_000 + "<p>x"
    dom = pages(spark, deep, None).select(outline(F.col("html")).alias("d")).collect()
    assert dom[0].d.pieces == ["x"] and dom[0].d.error is None
    assert dom[1].d.nodes == []


@pytest.mark.parametrize("depth", [10, 600, 20_000])
def test_depth_changes_no_review(spark, depth):
    article = "<article data-review-id=r1>" + "<i>" * depth + "<p>cuerpo</p><time datetime=2024></article>"
    html = "<div>" * depth + article + "</div>" * depth + "<p>fuera"
    rows = X.site_markup_reviews(pages(spark, html)).collect()
    assert [(r.review_id, r.body, r.date_published) for r in rows] == [("r1", "cuerpo", "2024")]


@pytest.mark.parametrize("mark", ["<!-- x ", "<script>", "<style a='", "<script "])
def test_unclosed_marks_take_linear_time(spark, mark):
    page = "application/ld" + mark * 40_000
    started = time.perf_counter()
    assert X.jsonld_reviews(pages(spark, page)).count() == 0
    assert time.perf_counter() - started < 10


def test_unclosed_comment_and_script_hide_the_rest(spark):
    review = '<script type="application/ld+json">{"@type": "Review", "reviewBody": "b"}</script>'
    for before, n in (("", 1), ("<!-- x", 0), ("<!-- x -->", 1), ("<script>", 0), ("<script></script>", 1)):
        assert X.jsonld_reviews(pages(spark, before + review)).count() == n


def test_unreadable_page_stops_no_other(monkeypatch):
    read = html_functions._Outline.feed

    def feed(self, page):
        if page == "bad":
            raise AssertionError("no")
        read(self, page)

    monkeypatch.setattr(html_functions._Outline, "feed", feed)
    got = html_functions._outlines(pa.array(["<p>a", "bad", "<p>b"])).to_pylist()
    assert [g["error"] for g in got] == [None, "AssertionError: no", None]
    assert [g["pieces"] for g in got] == [["a"], [], ["b"]]


MARKUP = st.lists(
    st.sampled_from(
        ["<p>", "</p>", "<div id=a>", "</div>", "<b>", "</b>", "<td>", "</table>", "<li>", "<a href=x>"]
        + ["</a>", "<br>", "<!--", "-->", "<script>", "</script>", "<", ">", "&", "&amp;", " ", "é", "'", '"', "<h3>"]
    ),
    max_size=40,
).map("".join)


@settings(deadline=None, max_examples=300)
@given(st.lists(MARKUP, max_size=4))
def test_outlines_hold_together(htmls):
    for dom in html_functions._outlines(pa.array(htmls, pa.string())).to_pylist():
        assert dom["error"] is None
        ends = []
        for i, node in enumerate(dom["nodes"]):
            assert 0 <= node["p0"] <= node["p1"] <= len(dom["pieces"])
            last = i + node["size"]
            assert last < len(dom["nodes"])
            while ends and ends[-1][0] < i:
                ends.pop()
            if ends:  # a node lies inside the nodes that are open around it
                assert last <= ends[-1][0] and node["p1"] <= ends[-1][1]
            ends.append((last, node["p1"]))
        assert all(piece == piece.strip() != "" for piece in dom["pieces"])


# --- structured data ------------------------------------------------------------


def test_scripts(spark):
    html = [
        script("1") + script("2", "type='application/ld+json' id=a") + script("3", "type=text/x"),
        "<!-- " + script("1") + " -->" + script("2", "id='>' TYPE = application/ld+json"),
        script("var s='<script type=\"application/ld+json\">';", "") + script("2"),
        script("1", 'type="application/ld&#x2B;json"') + script("2", 'data-type="application/ld+json"'),
        script("1", 'type="Application/ld+json"') + "<style>" + script("2") + "</style>",
        None,
    ]
    rows = pages(spark, *html).select("page_id", jsonld.scripts(F.col("html")).alias("s"))
    got = [r.s for r in rows.orderBy("page_id").collect()]
    assert got == [["1", "2"], ["2"], ["2"], ["1"], [], []]


REVIEW = {"@type": "Review", "name": "T", "reviewBody": "B"}


STRUCTURED = [
    (REVIEW, [("T", "B", None, None, "")]),
    ([{"x": [REVIEW]}, REVIEW], [("T", "B", None, None, "")] * 2),
    ({**REVIEW, "@type": "REVIEW"}, [("T", "B", None, None, "")]),
    ({**REVIEW, "@type": ["Review"]}, []),
    ({**REVIEW, "reviewRating": {"ratingValue": "4,5"}}, [("T", "B", None, None, "")]),
    ({**REVIEW, "reviewRating": {"ratingValue": 4}}, [("T", "B", 4.0, None, "")]),
    ({**REVIEW, "reviewRating": [1]}, [("T", "B", None, None, "")]),
    ({**REVIEW, "author": {"name": " Ana "}}, [("T", "B", None, "Ana", "")]),
    ({**REVIEW, "author": "Ana"}, [("T", "B", None, "Ana", "")]),
    ({**REVIEW, "author": ["Ana"]}, [("T", "B", None, None, "")]),
    ({**REVIEW, "name": 7, "datePublished": " d "}, [(None, "B", None, None, "d")]),
    ({**REVIEW, "name": "Escribe tu reseña"}, []),
    ({"@type": "Review", "reviewRating": {"ratingValue": 0}}, []),
    ('{"@type": "Review", "name": "a", "name": "b"}', [("b", None, None, None, "")]),
    ('{"@type": "Review", "name": "a", "x": NaN}', [("a", None, None, None, "")]),
    ('{"@type": "Review", "name": "a"} x', []),
    ("{'@type': 'Review'}", []),
    ('{"@type": "Review", "name": "\\ud800x"}', [("?x", None, None, None, "")]),
]


def by_page(df, *names):
    got = {}
    for page_id, *values in found(df, "page_id", *names):
        got.setdefault(page_id, []).append(tuple(values))
    return got


def test_structured_review(spark):
    rows = X.jsonld_reviews(pages(spark, *[script(data) for data, _ in STRUCTURED]))
    got = by_page(rows, "title", "body", "rating", "author", "date_published")
    for i, (data, expected) in enumerate(STRUCTURED):
        assert (data, got.get(i, [])) == (data, expected)


def test_structured_ids(spark):
    data = [
        {**REVIEW, "url": " https://h/Review/s/A1 ", "@id": "x"},
        {**REVIEW, "url": "  ", "@id": "x"},
        REVIEW,
    ]
    rows = X.jsonld_reviews(pages(spark, script(data)))
    assert found(rows, "review_id", "source_url") == [("A1", SITE), ("x", SITE), (None, SITE)]


def test_deep_payload(spark):
    data = "[" * 400 + json.dumps(REVIEW) + "]" * 400
    assert X.jsonld_reviews(pages(spark, script(data))).count() == 1


def test_long_payloads_with_mixed_characters(spark):
    data = {**REVIEW, "reviewBody": "a😀" * 300_000}
    html = script(json.dumps(data, ensure_ascii=False), 'type="application/ld+json" data-x="' + "y>" * 50_000 + '"')
    rows = X.jsonld_reviews(pages(spark, html)).select(F.length("body").alias("n")).collect()
    assert [r.n for r in rows] == [600_000]


def test_objects_in_order(spark):
    html = script({"a": {"name": "2"}, "name": "1", "b": [{"name": "3"}]}) + script("x") + script({"name": "4"})
    objects = X.json_objects(X.jsonld_payloads(pages(spark, html)))
    got = objects.orderBy("script", "node").select("script", "node", "name").collect()
    assert [tuple(r) for r in got] == [(0, 0, "1"), (0, 1, "2"), (0, 2, "3"), (2, 0, "4")]


# --- the site's markup ------------------------------------------------------------


def site(spark, html, *names):
    return found(X.site_markup_reviews(pages(spark, html)), *names)


def test_site_review(spark):
    html = """<article data-service-review-id="a1" data-service-review-rating="5">
      <a data-consumer-profile-reviews-link>Bob <b>K</b></a><h2>no</h2><strong>Muy
      bien</strong><p>uno</p><p>dos</p><time datetime=" 2024-01-01 ">ayer</time>
      <span data-consumer-country-flag title="ES">x</span></article>"""
    assert site(spark, html, *REVIEW_COLS) == [
        ("a1", "Muy bien", "uno", 5.0, "Bob K", "2024-01-01", "ES", SITE)
    ]


SITE_FIELDS = [
    ("<p></p><p>dos</p>", "body", None),
    ("<h3>Eva</h3><a data-consumer-profile-reviews-link> </a>", "author", "Eva"),
    ("<i aria-label='Rated 3 out of 5'></i>", "rating", 3.0),
    ("<i aria-label='Rated 3 OUT OF 5'></i>", "rating", None),
    ("<img alt='Rated 2.5 out of 5'>", "rating", 2.5),
    ("<i alt='Rated 2.5 out of 5'></i>", "rating", None),
    ("<img alt='1 out of 5'><i aria-label='4 out of 5'></i>", "rating", 4.0),
    ("<time>ayer</time>", "date_published", "ayer"),
    ("<i data-consumer-country-flag></i><i data-consumer-country-flag title=ES></i>", "location", None),
    ("<strong></strong><strong>b</strong>", "title", None),
]


def test_site_fields(spark):
    html = [f"<div data-review-id=r>{x}<time datetime=z></time></div>" for x, _, _ in SITE_FIELDS]
    rows = X.site_markup_reviews(pages(spark, *html)).collect()
    got = {r.page_id: r for r in rows}
    for i, (inside, name, expected) in enumerate(SITE_FIELDS):
        assert (inside, got[i][name]) == (inside, expected)


def test_site_rating_falls_back_when_unreadable(spark):
    html = "<p data-reviewid=r data-service-review-rating=x><i aria-label='2 out of 5'></i></p>"
    assert site(spark, html, "rating") == [(2.0,)]


def test_site_blocks_come_by_selector(spark):
    html = """<i data-review-content><strong>1</strong></i><i data-review-id=b><strong>2</strong>
      <i data-service-review-id data-reviewid=c><strong>3</strong></i></i>"""
    assert site(spark, html, "review_id", "title") == [("c", "3"), ("b", "2"), (None, "1")]


def test_site_call_to_action_keeps_the_row(spark):
    html = "<div data-review-id=r><strong>Hola</strong><p>ESCRIBE tu reseña<time datetime=d></time></div>"
    assert site(spark, html, "title", "body", "date_published") == [(None, None, "d")]


# --- common markup ------------------------------------------------------------------


def generic(spark, html, *names):
    return found(X.generic_markup_reviews(pages(spark, html, url=OTHER)), *names)


def test_generic_review(spark):
    html = """<div itemprop="review" data-review-id=" 7 "><h2>no</h2><b itemprop="name">T</b>
      <div itemprop="description">B <i>c</i></div><meta itemprop="ratingValue" content="4.5 de 5">
      <span itemprop="author"><i itemprop="name">Zoe</i> x</span>
      <i itemprop="datePublished" datetime="2024">y</i><i itemprop="address">Madrid</i></div>"""
    assert generic(spark, html, *REVIEW_COLS) == [
        ("7", "T", "B c", 4.5, "Zoe", "2024", "Madrid", OTHER)
    ]


GENERIC_FIELDS = [
    ("<h3>T</h3>", "title", "T"),
    ("<i itemprop=description> </i><p>q</p>", "body", "q"),
    ("<i itemprop=ratingValue>nada</i><i data-rating='3 estrellas'></i>", "rating", 3.0),
    ("<i title='2 de 5'></i>", "rating", 2.0),
    ("<i title='2'></i><i data-rating=''></i>", "rating", None),
    ("<i itemprop=author></i><i class='the reviewer-x'>Ana</i>", "author", None),
    ("<i class='the Reviewer-x'>Ana</i>", "author", "Ana"),
    ("<time>ayer</time>", "date_published", "ayer"),
    ("<i class=my-country>ES</i>", "location", "ES"),
]


def test_generic_fields(spark):
    html = [f"<div id=review-1>{inside}<p>b</p></div>" for inside, _, _ in GENERIC_FIELDS]
    got = {r.page_id: r for r in X.generic_markup_reviews(pages(spark, *html)).collect()}
    for i, (inside, name, expected) in enumerate(GENERIC_FIELDS):
        assert (inside, got[i][name]) == (inside, expected)


def test_generic_blocks(spark):
    html = """<div id="Review 12"><p>1</p></div><div id=preview-3><p>no</p></div>
      <div itemtype="http://schema.org/review"><p>2</p></div><div itemprop=review><p>3</p></div>
      <div itemprop=review><b>sin nada</b></div><div itemprop=review><p>Write your review</p></div>
      <div itemprop=review><p> </p></div>"""
    assert generic(spark, html, "review_id", "body") == [(None, "3"), (None, "2"), ("Review 12", "1")]


def test_generic_id_attributes(spark):
    html = "<div id=review-1 data-review-id=''><p>b</p></div><div id='review&#45;2'><p>c</p></div>"
    assert generic(spark, html, "review_id") == [(None,), ("review-2",)]


# --- both, and links -------------------------------------------------------------------


def test_sources_of_a_page(spark):
    html = script(REVIEW) + "<div data-review-id=r><p>x</p><div itemprop=review><p>y</p></div></div>"
    on_site = X.extract_reviews(pages(spark, html))
    assert found(on_site, "source_rank", "body") == [(0, "B"), (1, "x")]
    elsewhere = X.extract_reviews(pages(spark, html, url=OTHER))
    assert found(elsewhere, "source_rank", "body") == [(0, "B"), (1, "y"), (1, "x")]


NEXT = [
    ("<a rel='nofollow NEXT' href='/b'>x</a>", "http://h/a/c", "http://h/b"),
    ("<link rel=next href=/b>", "http://h/a", "http://h/a?page=2"),
    ("<a rel=next>x</a><a rel=next href=/no>x</a><a href=c>Siguiente</a>", "http://h/a/b", "http://h/a/c"),
    ("<a href=1>older</a><a href=2>Next page</a>", "http://h/", "http://h/2"),
    ("<a href=1>a <b>next</b></a><a href=2><b>next</b></a>", "http://h/", "http://h/2"),
    ("<a>next</a><a href=1>next</a><a href=2>&raquo;</a>", "http://h/", "http://h/2"),
    ("<a href='?page=9'>&gt;</a>", "http://h/p?page=3", "http://h/p?page=9"),
    ("<a href='//o/x'>»</a>", "https://h/", "https://o/x"),
    ("", "http://h/p?q=1&page=3#x", "http://h/p?q=1&page=4#x"),
    ("", "http://h/p?page=x", None),
    ("<a rel=next href='http://[x'>x</a>", "http://h/p", None),
    (None, "http://h/p", "http://h/p?page=2"),
]


def test_next_page(spark):
    rows = spark.createDataFrame(
        [(i, url, html) for i, (html, url, _) in enumerate(NEXT)],
        "page_id int, url string, html string",
    )
    for row in X.next_page_url(rows).collect():
        assert (NEXT[row.page_id][0], row.next_url) == (NEXT[row.page_id][0], NEXT[row.page_id][2])


def test_fallback(spark):
    a = spark.createDataFrame([("x", "u", 0), ("x", "u", 1)], "company string, source_url string, pos int")
    b = spark.createDataFrame(
        [("x", "v", 0)] + [("y", "v", i) for i in range(200)], a.schema
    )
    got = X.with_fallback(a, b).groupBy("company", "source_url").count().orderBy("company").collect()
    assert [tuple(r) for r in got] == [("x", "u", 2), ("y", "v", 200)]


def test_no_html_goes_past_the_parser(spark):
    assert "html" not in X.parse_pages(pages(spark, "")).columns
    assert "html" not in X.extract_reviews(pages(spark, "")).columns


@pytest.mark.parametrize("mark", ["data-review-id=r", "itemprop=review"])
def test_nested_blocks_take_linear_time(spark, mark):
    def seconds(n):
        html = f"<div {mark}><b>t</b>" * n + "<p>cuerpo</p>" + "<i title='4'></i></div>" * n
        rows = (X.site_markup_reviews if "data" in mark else X.generic_markup_reviews)(pages(spark, html))
        started = time.time()
        assert rows.where("body = 'cuerpo'").count() == n
        return time.time() - started

    seconds(10)
    assert seconds(3000) < 8 * seconds(1000) + 5


def test_calls_over_several_pieces(spark):
    html = """<div itemprop=review data-review-id=1><b>Escribe</b> <i>tu</i><p>reseña</p></div>
      <div itemprop=review data-review-id=2><b>Escribe</b><p>tu</p></div>
      <div itemprop=review data-review-id=3><p>Write your</p></div> review"""
    assert generic(spark, html, "review_id") == [("2",), ("3",)]


# --- batches in parts -----------------------------------------------------------


def test_parts_are_bounded_and_lose_no_row():
    rows = ["x" * 300_000] * 9 + [None, ""] + ["y" * 3_000_000] + ["z"]
    for batch in (pa.array(rows, pa.string()), pa.array([[r, r] for r in rows], pa.list_(pa.string()))):
        parts = list(arrow.parts(batch.slice(1)))
        assert [v for p in parts for v in p.to_pylist()] == batch.to_pylist()[1:]
        assert all(p.nbytes < 1.1 * arrow.PART or len(p) == 1 for p in parts) and len(parts) > 4
    assert list(arrow.parts(pa.array([], pa.string()))) == []


def test_payloads_are_read_once(spark):
    payloads = X.jsonld_payloads(pages(spark, script({"@type": "Review"}), script("{"), "<p>"))
    for df in (payloads, X.json_objects(payloads).groupBy("type").count()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len([line for line in plan.split("\n") if "+- ArrowEvalPython" in line]) == 1
    assert found(payloads, "page_id", "script") == [(0, 0)]


def test_deep_pages_are_outlined_without_the_slow_parser(monkeypatch):
    slow = []
    general = html_functions.HTMLParser.parse_starttag
    monkeypatch.setattr(html_functions.HTMLParser, "parse_starttag", lambda p, i: slow.append(i) or general(p, i))
    html = "<div>" * 1000 + "<p>uno<STYLE>p</b>{}</STYLE><b class=x>dos</b></p>" + "</div>" * 1000
    (dom,) = html_functions._outlines(pa.array([html])).to_pylist()
    assert dom["pieces"] == ["uno", "dos"] and [n["tag"] for n in dom["nodes"]] == ["p", "b"]
    assert len(slow) == 2


def test_deep_reviews_use_all_cores(spark):
    query = catalog_pages.deep_reviews(spark, "/root/testdata/sf0.001")
    assert "REPARTITION_BY_NUM" in query._jdf.queryExecution().executedPlan().toString()
