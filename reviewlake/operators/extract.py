"""Reviews and links out of page snapshots ``(url, html, ...)``.

The structured data and the outline of a page are read once per page; the rules
that turn them into reviews are column expressions. Where each rule fits is found once per
page; a block's first fit is looked up by halving, and nothing of the page is copied
per block, so nested blocks cost no more than others. Per-page results stay one row
(arrays) until they are exploded, so the HTML is never copied per review.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsonld, text, urls
from ..functions.html import outline
from ..schema import REVIEW_COLS
from ..scratch import materialize
from .filters import prune_empty

# Fixed values.
SITE_BLOCK_ATTRS = [
    "data-service-review-id",
    "data-review-id",
    "data-reviewid",
    "data-review-content",
]
SITE_ID_ATTRS = SITE_BLOCK_ATTRS[:3]
HEADINGS = ["h2", "h3", "h4"]
NEXT_WORDS = ["next", "siguiente", "older", "»", ">"]
PERSON_CLASS = r"(?i)(author|reviewer|consumer)"
PLACE_CLASS = r"(?i)(location|country|city)"
REVIEW_ITEM_TYPE = r"(?i)/Review$"
REVIEW_ID = r"(?iU)\breview[-_ ]?\d+"

# A page without these marks has no review block, so its outline is not needed.
_SITE_MARK = "(?i)" + "|".join(SITE_BLOCK_ATTRS)
_GENERIC_MARK = (
    r"(?i)itemprop|itemtype|data-review-id"
    r"""|\bid\s*=\s*(?:"[^"]*?(?:review|&)|'[^']*?(?:review|&)|[^\s"'>]*?(?:review|&))"""
)

NO_HTML = "no HTML"

REVIEW_STRUCT = (
    "array<struct<review_id: string, title: string, body: string, rating: double,"
    " author: string, date_published: string, location: string, pos: bigint>>"
)

Rule = Callable[[Column], Column]


# --- looking around in an outline -------------------------------------------


def _said(c: Column) -> Column:
    """The text, null if it is empty.

    Inside a lambda the usual ``nullif`` would work out its argument twice.
    """
    return F.get(F.array_remove(F.array(c), ""), F.lit(0))


def _clean(c: Column) -> Column:
    return _said(text.collapse(c))


def _has(node: Column, attr: str) -> Column:
    return F.map_contains_key(node["attrs"], F.lit(attr))


def _attr(node: Column, attr: str) -> Column:
    """The attribute, null if it is missing or empty."""
    return _said(node["attrs"][attr])


def _is(tag: str) -> Rule:
    return lambda n: n["tag"] == tag


def _prop(value: str) -> Rule:
    return lambda n: F.coalesce(n["attrs"]["itemprop"] == value, F.lit(False))


def _attr_like(attr: str, pattern: str) -> Rule:
    return lambda n: F.coalesce(F.rlike(n["attrs"][attr], F.lit(pattern)), F.lit(False))


def _first(nodes: Column, rule: Rule) -> Column:
    return F.get(F.filter(nodes, rule), F.lit(0))


def _places(items: Column, rule: Callable[..., Column]) -> Column:
    """The places of the items that a rule fits, in order."""
    marked = F.transform(items, lambda x, i: F.when(rule(x), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _next(places: Column, steps: Column, start: Column, end: Column) -> Column:
    """The first of sorted places from ``start`` up to ``end``, by halving.

    ``steps`` are the powers of two up to the number of places or more, the largest first.
    """
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda below, k: F.when(F.get(places, below + k - 1) < start, below + k).otherwise(below),
        lambda below: F.get(places, below),
    )
    return F.get(F.filter(F.array(found), lambda i: i <= end), F.lit(0))


def _steps(most: Column) -> Column:
    bits = F.sequence(F.length(F.bin(most)) - 1, F.lit(0), F.lit(-1))
    return F.transform(bits, lambda k: F.pow(F.lit(2), k).cast("int"))


class _Page:
    """A page's outline within a lambda: its nodes, its text, and where each rule fits."""

    def __init__(self, env: Column):
        self.env, self.nodes, self.pieces = env, env["nodes"], env["pieces"]

    def node(self, at: Column) -> Column:
        return F.get(self.nodes, at)

    def place(self, rule: str, block: Column) -> Column:
        """Of the nodes inside ``block``, the place of the first that the rule fits."""
        return _next(self.env[rule], self.env["steps"], block["at"] + 1, block["at"] + block["node"]["size"])

    def first(self, rule: str, block: Column) -> Column:
        return self.node(self.place(rule, block))

    def text(self, node: Column) -> Column:
        """Text of a node, null if there is none."""
        return _said(F.array_join(F.slice(self.pieces, node["p0"] + 1, node["p1"] - node["p0"]), " "))


def _on_page(dom: Column, rules: dict[str, Rule], body: Callable[[_Page], Column], **more: Column) -> Column:
    """``body`` of the page, on which the places of each rule have been found once."""
    env = F.struct(
        dom["nodes"].alias("nodes"),
        dom["pieces"].alias("pieces"),
        _steps(F.greatest(F.size(dom["nodes"]), F.size(dom["pieces"]))).alias("steps"),
        *[_places(dom["nodes"], rule).alias(name) for name, rule in rules.items()],
        *[c.alias(name) for name, c in more.items()],
    )
    # The one-element array gives the places a name, so they are found once.
    return F.get(F.transform(F.array(env), lambda e: body(_Page(e))), F.lit(0))


def _blocks(page: _Page, rank: Rule) -> Column:
    """The nodes with a rank, by rank and then position: ``node, at``."""
    ranked = F.transform(page.nodes, lambda n, i: F.struct(rank(n).alias("rank"), i.alias("at")))
    chosen = F.array_sort(F.filter(ranked, lambda s: s["rank"].isNotNull()))
    return F.transform(chosen, lambda s: F.struct(page.node(s["at"]).alias("node"), s["at"].alias("at")))


def _any_of(rules: list[Rule]) -> Rule:
    """Number of the first rule that fits."""

    def rank(n: Column) -> Column:
        return F.coalesce(*[F.when(rule(n), F.lit(i)) for i, rule in enumerate(rules)])

    return rank


def _reviews(raw: Column, review_id: Rule) -> Column:
    """Markup reviews; a call to action loses its title and body."""
    asked = F.transform(
        raw, lambda r: r.withField("call", text.has_call_to_action(r["title"], r["body"]))
    )
    return F.transform(
        asked,
        lambda r, i: F.struct(
            review_id(r["id"]).alias("review_id"),
            F.when(~r["call"], _clean(r["title"])).alias("title"),
            F.when(~r["call"], _clean(r["body"])).alias("body"),
            r["rating"].alias("rating"),
            _clean(r["author"]).alias("author"),
            text.norm(r["date"]).alias("date_published"),
            _clean(r["location"]).alias("location"),
            i.cast("bigint").alias("pos"),
        ),
    )


# --- the review site's own markup -------------------------------------------


def site_blocks(page: _Page) -> Column:
    """Review blocks of the review site's pages."""
    return _blocks(page, _any_of([lambda n, a=a: _has(n, a) for a in SITE_BLOCK_ATTRS]))


SITE_RULES: dict[str, Rule] = {
    "body": _is("p"),
    "profile": lambda n: _has(n, "data-consumer-profile-reviews-link"),
    "heading": lambda n: n["tag"].isin(HEADINGS),
    "labelled": _attr_like("aria-label", "out of"),
    "pictured": lambda n: (n["tag"] == "img") & _attr_like("alt", "out of")(n),
    "time": _is("time"),
    "strong": _is("strong"),
    "flag": lambda n: _has(n, "data-consumer-country-flag"),
}


def site_reviews(dom: Column) -> Column:
    """Reviews of the review site's pages."""
    return _on_page(dom, SITE_RULES, _site_reviews)


def _site_reviews(page: _Page) -> Column:
    def found(b: Column) -> Column:
        names = ("body", "profile", "heading", "time", "strong", "flag")
        stars = F.coalesce(page.first("labelled", b), page.first("pictured", b))
        nodes = [page.first(name, b).alias(name) for name in names]
        return F.struct(b["node"].alias("block"), stars.alias("stars"), *nodes)

    raw = F.transform(
        F.transform(site_blocks(page), found),
        lambda f: F.struct(
            F.coalesce(*[_attr(f["block"], a) for a in SITE_ID_ATTRS]).alias("id"),
            page.text(f["strong"]).alias("title"),
            page.text(f["body"]).alias("body"),
            F.coalesce(
                text.rating_float(f["block"]["attrs"]["data-service-review-rating"]),
                text.rating_out_of(
                    F.coalesce(
                        _attr(f["stars"], "aria-label"),
                        _attr(f["stars"], "alt"),
                        page.text(f["stars"]),
                    )
                ),
            ).alias("rating"),
            F.coalesce(page.text(f["profile"]), page.text(f["heading"])).alias("author"),
            F.coalesce(_attr(f["time"], "datetime"), page.text(f["time"])).alias("date"),
            _attr(f["flag"], "title").alias("location"),
        ),
    )
    return _reviews(raw, text.clean_review_id)


# --- common review markup of other sites ------------------------------------

GENERIC_RULES: dict[str, Rule] = {
    "name": _prop("name"),
    "heading": lambda n: n["tag"].isin(HEADINGS),
    "description": _prop("description"),
    "paragraph": _is("p"),
    "value": _prop("ratingValue"),
    "rated": lambda n: _has(n, "data-rating"),
    "titled": _attr_like("title", r"(?U)\d"),
    "author": _prop("author"),
    "person": _attr_like("class", PERSON_CLASS),
    "date": _prop("datePublished"),
    "time": _is("time"),
    "address": _prop("address"),
    "place": _attr_like("class", PLACE_CLASS),
    "telling": lambda n: _prop("description")(n)
    | (n["tag"] == "p")
    | _prop("ratingValue")(n)
    | _has(n, "data-rating")
    | _prop("author")(n)
    | _attr_like("class", PERSON_CLASS)(n),
}
#: Pieces of text over which a call to action can spread, as it has as many words.
CALL_PIECES = max(len(phrase.split()) for phrase in text.SKIP_PHRASES)


def _calls(pieces: Column) -> dict[str, Column]:
    """For each number of pieces, the places from which that many have a call to action."""
    at = F.sequence(F.lit(0), F.size(pieces) - 1)
    places = F.when(F.size(pieces) > 0, at).otherwise(F.array().cast("array<int>"))

    def calling(k: int) -> Column:
        return F.filter(places, lambda i: text.has_call_to_action(F.array_join(F.slice(pieces, i + 1, k), " ")))

    return {f"call{k}": calling(k) for k in range(1, CALL_PIECES + 1)}


def generic_blocks(page: _Page) -> Column:
    """Elements marked as reviews that say something and are no call to action."""
    rank = _any_of(
        [
            _prop("review"),
            _attr_like("itemtype", REVIEW_ITEM_TYPE),
            lambda n: _has(n, "data-review-id"),
            _attr_like("id", REVIEW_ID),
        ]
    )

    def worth_reading(b: Column) -> Column:
        p0, p1 = b["node"]["p0"], b["node"]["p1"]
        calls = [_next(page.env[f"call{k}"], page.env["steps"], p0, p1 - k).isNull() for k in range(1, CALL_PIECES + 1)]
        return (p1 > p0) & page.place("telling", b).isNotNull() & reduce(and_, calls)

    return F.filter(_blocks(page, rank), worth_reading)


def generic_reviews(dom: Column) -> Column:
    """Reviews of pages with common review markup."""
    return _on_page(dom, GENERIC_RULES, _generic_reviews, **_calls(dom["pieces"]))


def _generic_reviews(page: _Page) -> Column:
    def found(b: Column) -> Column:
        names = ("name", "heading", "description", "paragraph", "value", "author", "person", "address", "place")
        return F.struct(
            b["node"].alias("block"),
            *[page.first(name, b).alias(name) for name in names],
            F.coalesce(page.first("rated", b), page.first("titled", b)).alias("stars"),
            _author_name_node(page, b).alias("author_name"),
            F.coalesce(page.first("date", b), page.first("time", b)).alias("date"),
        )

    raw = F.transform(
        F.transform(generic_blocks(page), found),
        lambda f: F.struct(
            _generic_id(f["block"]).alias("id"),
            F.coalesce(page.text(f["name"]), page.text(f["heading"])).alias("title"),
            F.coalesce(page.text(f["description"]), page.text(f["paragraph"])).alias("body"),
            F.coalesce(
                text.rating_first_number(
                    F.coalesce(_attr(f["value"], "content"), page.text(f["value"]))
                ),
                text.rating_first_number(
                    F.coalesce(_attr(f["stars"], "data-rating"), _attr(f["stars"], "title"))
                ),
            ).alias("rating"),
            F.when(
                f["author"].isNotNull(),
                F.coalesce(page.text(f["author_name"]), page.text(f["author"])),
            )
            .otherwise(page.text(f["person"]))
            .alias("author"),
            F.coalesce(_attr(f["date"], "datetime"), page.text(f["date"])).alias("date"),
            F.coalesce(page.text(f["address"]), page.text(f["place"])).alias("location"),
        ),
    )
    return _reviews(raw, _clean)


def _generic_id(block: Column) -> Column:
    return F.when(_has(block, "data-review-id"), block["attrs"]["data-review-id"]).when(
        _attr_like("id", REVIEW_ID)(block), block["attrs"]["id"]
    )


def _author_name_node(page: _Page, block: Column) -> Column:
    """The name inside the first author element."""
    author = F.transform(
        F.array(page.place("author", block)), lambda i: F.struct(page.node(i).alias("node"), i.alias("at"))
    )
    return F.get(F.transform(author, lambda a: page.first("name", a)), F.lit(0))


# --- structured data ---------------------------------------------------------


def jsonld_reviews_of(nodes: Column) -> Column:
    """Reviews among the objects of a page's structured data."""
    reviews = F.filter(
        nodes, lambda n: F.coalesce(F.lower(n["type"]) == "review", F.lit(False))
    )
    rows = F.transform(
        reviews,
        lambda n, i: F.struct(
            text.clean_review_id(
                F.coalesce(
                    _said(text.norm(n["url"])), text.norm(n["id"])
                )
            ).alias("review_id"),
            _clean(n["name"]).alias("title"),
            _clean(n["body"]).alias("body"),
            text.rating_float(n["rating"]).alias("rating"),
            _clean(
                text.author_name(n["author"], n["author_is_object"], n["author_name"])
            ).alias("author"),
            text.norm(n["date"]).alias("date_published"),
            F.lit(None).cast("string").alias("location"),
            i.cast("bigint").alias("pos"),
        ),
    )
    return F.filter(rows, lambda r: ~text.has_call_to_action(r["title"], r["body"]))


# --- tables -------------------------------------------------------------------


def _page_cols(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c != "html"]


def _explode_reviews(parsed: DataFrame, reviews: Column) -> DataFrame:
    """One row per review, empty ones left out, in the fixed column order."""
    # Not explode(): that one has the array worked out once more, to filter on its
    # size. Pages without reviews give an empty row here, which goes with the others.
    rows = parsed.select("*", F.explode_outer(reviews).alias("_r"))
    extra = [c for c in parsed.columns if c not in {"url", *REVIEW_COLS, *_PARSED}]
    return prune_empty(
        rows.select(
            *[F.col("_r")[c].alias(c) for c in REVIEW_COLS if c != "source_url"],
            F.col("url").alias("source_url"),
            *extra,
            *([F.col("_r.source_rank")] if "source_rank" in _fields(rows) else []),
            F.col("_r.pos").alias("pos"),
        )
    )


def _fields(rows: DataFrame) -> list[str]:
    return rows.schema["_r"].dataType.fieldNames()


_PARSED = {"jsonld", "site", "generic", "next_url", "error"}


def jsonld_payloads(pages: DataFrame) -> DataFrame:
    """One row per valid structured-data script: page columns, ``script``, payload, objects."""
    return (
        pages.select(
            *_page_cols(pages), F.posexplode(jsonld.scripts(F.col("html"))).alias("script", "payload")
        )
        .withColumn("nodes", jsonld.json_nodes(F.col("payload")))
        .where(F.col("nodes").isNotNull())
    )


def json_objects(payloads: DataFrame) -> DataFrame:
    """One row per object of the payloads, parents before members (``node``)."""
    kept = [c for c in payloads.columns if c not in {"payload", "nodes"}]
    return payloads.select(*kept, F.posexplode("nodes").alias("node", "_o")).select(
        *kept, "node", "_o.*"
    )


def parse_pages(pages: DataFrame, links: bool = True) -> DataFrame:
    """Each page once: reviews by source, next page, reading error; no HTML.

    Without ``links`` pages that cannot hold review markup are not outlined.
    """
    html = F.col("html")
    is_site, is_generic = (
        F.coalesce(F.rlike(html, F.lit(mark)), F.lit(False)) for mark in (_SITE_MARK, _GENERIC_MARK)
    )
    read = pages.select(
        *_page_cols(pages),
        is_site.alias("_is_site"),
        is_generic.alias("_is_generic"),
        html.isNull().alias("_unread"),
        outline(html if links else F.when(is_site | is_generic, html)).alias("_dom"),
        jsonld.page_nodes(jsonld.scripts(html)).alias("_nodes"),
    )
    dom = F.col("_dom")
    parsed = read.select(
        *_page_cols(pages),
        jsonld_reviews_of(F.col("_nodes")).alias("jsonld"),
        # The marks spare a page the rules that cannot find anything in it.
        F.when(F.col("_is_site"), site_reviews(dom)).alias("site"),
        F.when(F.col("_is_generic"), generic_reviews(dom)).alias("generic"),
        F.coalesce(F.when(F.col("_unread"), F.lit(NO_HTML)), dom["error"]).alias("error"),
        *([_link(dom).alias("_href")] if links else []),
    )
    if not links:
        return parsed
    return parsed.withColumn("next_url", urls.follow(F.col("url"), F.col("_href"))).drop("_href")


def page_reviews(parsed: DataFrame, on_site: Column | None = None) -> DataFrame:
    """Reviews of parsed pages: structured data, then markup, in page order.

    ``on_site`` picks the markup rules; by default the page's own host does.
    """
    on_site = urls.is_site_host(F.col("url")) if on_site is None else on_site
    markup = F.when(on_site, F.col("site")).otherwise(F.col("generic"))
    return _explode_reviews(
        parsed,
        F.concat(_ranked(F.col("jsonld"), 0), _ranked(markup, 1)),
    )


def _ranked(reviews: Column, source_rank: int) -> Column:
    return F.transform(
        F.coalesce(reviews, F.array().cast(REVIEW_STRUCT)),
        lambda r: r.withField("source_rank", F.lit(source_rank)),
    )


def extract_reviews(pages: DataFrame) -> DataFrame:
    """All reviews of a page table."""
    return page_reviews(parse_pages(pages, links=False))


def jsonld_reviews(pages: DataFrame) -> DataFrame:
    """Reviews of the structured data only."""
    nodes = jsonld.page_nodes(jsonld.scripts(F.col("html")))
    read = pages.select(*_page_cols(pages), nodes.alias("_nodes"))
    parsed = read.select(*_page_cols(pages), jsonld_reviews_of(F.col("_nodes")).alias("jsonld"))
    return _explode_reviews(parsed, F.col("jsonld"))


def _dom_reviews(pages: DataFrame, mark: str, rules: Rule, name: str) -> DataFrame:
    read = pages.where(F.rlike("html", F.lit(mark))).select(
        *_page_cols(pages), outline(F.col("html")).alias("_dom")
    )
    parsed = read.select(*_page_cols(pages), rules(F.col("_dom")).alias(name))
    return _explode_reviews(parsed, F.col(name))


def site_markup_reviews(pages: DataFrame) -> DataFrame:
    """Reviews in the review site's markup only."""
    return _dom_reviews(pages, _SITE_MARK, site_reviews, "site")


def generic_markup_reviews(pages: DataFrame) -> DataFrame:
    """Reviews in common review markup only."""
    return _dom_reviews(pages, _GENERIC_MARK, generic_reviews, "generic")


def _link(dom: Column) -> Column:
    """Target of the link to the next page, by relation and then by text."""
    anchors = F.filter(dom["nodes"], _is("a"))
    by_relation = _first(anchors, lambda a: _mentions(a["attrs"]["rel"], "next"))
    by_text = [_first(anchors, _says(word)) for word in NEXT_WORDS]
    return F.coalesce(*[_attr(a, "href") for a in [by_relation, *by_text]])


def _mentions(c: Column, word: str) -> Column:
    return F.coalesce(F.contains(F.lower(c), F.lit(word)), F.lit(False))


def _says(word: str) -> Rule:
    return lambda a: _mentions(a["only"], word)


def next_page_url(pages: DataFrame) -> DataFrame:
    """Page columns with ``next_url``: a link, else the URL with its page raised."""
    read = pages.select(*_page_cols(pages), outline(F.col("html")).alias("_dom"))
    linked = read.select(*_page_cols(pages), _link(F.col("_dom")).alias("_href"))
    return linked.select(
        *_page_cols(pages), urls.follow(F.col("url"), F.col("_href")).alias("next_url")
    )


def with_fallback(
    primary: DataFrame,
    secondary: DataFrame,
    key: str = "company",
) -> DataFrame:
    """``primary``, and ``secondary`` for the keys ``primary`` has no row for.

    Both are written down first, since each is read twice.
    """
    primary, secondary = materialize(primary), materialize(secondary)
    missing = secondary.select(key).distinct().join(
        primary.select(key).distinct(), key, "left_anti"
    )
    return primary.unionByName(secondary.join(missing, key, "left_semi"))
