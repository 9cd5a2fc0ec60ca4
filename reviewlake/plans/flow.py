"""Harvest, clean, classify, load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import text, urls
from ..operators.chain import page_chain
from ..operators.classify import Labeler, classify
from ..operators.dedup import cap_per_company, dedup_by_fingerprint, dedup_by_id, head
from ..operators.extract import page_reviews, parse_pages
from ..operators.filters import drop_missing_id, drop_sample
from ..schema import ORDER_COLS
from ..scratch import materialize
from ..sources.companies import with_start
from ..sources.write import load_table

# Fixed values.
TEST_MODE_ROWS = 3

NO_PAGE = "no page"


def clean_reviews(df: DataFrame, order: Sequence[str] = ("company", "row")) -> DataFrame:
    """Without test data, rows without id, and repeated ids."""
    return dedup_by_id(drop_missing_id(drop_sample(df)), order)


def _places(parsed: DataFrame, specs: DataFrame, max_pages: int | None) -> DataFrame:
    """The pages of each company's chain: its columns, ``url, page_id, page_seq, error``.

    Works on addresses and links alone; no review is moved.
    """
    page = F.min_by(F.struct("page_id", "next_url", "error"), F.col("page_id")).alias("p")
    pages = materialize(parsed.groupBy("url").agg(page).select("url", "p.*"))
    chain = page_chain(pages, specs.select("start"), max_pages)
    return materialize(chain.join(specs, "start").join(pages.drop("next_url"), "url"))


def _parsed(pages: DataFrame) -> DataFrame:
    """Each page read once and written without its HTML, where it was read."""
    return materialize(parse_pages(pages.select("page_id", "url", "html")))


def _harvest(pages: DataFrame, specs: DataFrame, max_pages: int | None) -> DataFrame:
    """Reviews of each company's pages, empty ones left out."""
    parsed = _parsed(pages)
    places = _places(parsed, specs, max_pages).drop("error")
    # The one time that reviews are moved, unless the places are few enough to be sent to them.
    seen = parsed.select("url", "page_id", "jsonld", "site", "generic").join(places, ["url", "page_id"])
    # The rules are chosen by the start of the chain, once for all its pages.
    return page_reviews(seen.drop("page_id"), on_site=urls.is_site_host(F.col("start")))


def harvest_failures(pages: DataFrame, specs: DataFrame, max_pages: int | None = None) -> DataFrame:
    """``company, url, error`` of unreadable pages and of companies without any page."""
    specs = materialize(with_start(specs))
    places = _places(_parsed(pages), specs, max_pages)
    unread = places.where("error is not null").select("company", "url", "error")
    lacking = specs.join(places.select("start").distinct(), "start", "left_anti")
    return unread.unionByName(
        lacking.select("company", F.col("start").alias("url"), F.lit(NO_PAGE).alias("error"))
    )


def harvest(
    pages: DataFrame,
    specs: DataFrame,
    max_pages: int | None = None,
    max_reviews: int | None = None,
    rendered: DataFrame | None = None,
) -> DataFrame:
    """Reviews of the listed companies, found by following each one's pages.

    ``rendered`` is a second snapshot, used for companies the first one has
    nothing for. A page that cannot be read has no reviews and stops no other.
    """
    specs = materialize(with_start(specs))
    found = _harvest(pages, specs, max_pages)
    if rendered is not None:
        found = materialize(found)
        # Only the companies without a row are looked up in the second snapshot.
        lacking = specs.join(found.select("start").distinct(), "start", "left_anti")
        found = found.unionByName(_harvest(rendered, materialize(lacking), max_pages))
    scope = ["company", "start"]
    unique = dedup_by_fingerprint(found, ORDER_COLS, scope)
    if max_reviews is not None:
        unique = cap_per_company(unique, max_reviews, ORDER_COLS, scope)
    return unique


def combine(harvested: DataFrame) -> DataFrame:
    """Harvested rows under the company name their review file would give them."""
    return harvested.withColumn("company", text.company_from_slug(F.col("slug")))


def run(
    pages: DataFrame,
    specs: DataFrame,
    labeler: Labeler,
    table: str,
    test_mode: bool = False,
    max_pages: int | None = None,
    rendered: DataFrame | None = None,
    table_path: str | None = None,
    **labeling,
) -> DataFrame:
    """From pages to the loaded table; the classified rows.

    ``test_mode`` takes three reviews per company, classifies three rows and
    loads nothing.
    """
    cap = TEST_MODE_ROWS if test_mode else None
    order = ["company", "start", *ORDER_COLS]
    reviews = clean_reviews(combine(harvest(pages, specs, max_pages, cap, rendered)), order)
    if test_mode:
        reviews = head(reviews, TEST_MODE_ROWS, order)
    classified = classify(materialize(reviews), labeler, **labeling)
    if test_mode:
        return classified
    load_table(classified, table, table_path)
    return classified.sparkSession.read.table(table)
