"""Extraction: pages are made of the reviews, and the reviews read out of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import extract as X
from reviewlake.operators.chain import page_chain
from reviewlake.plans import flow
from reviewlake.plans.flow import clean_reviews, combine, harvest, run
from reviewlake.scratch import materialize, scratch_dir
from reviewlake.sources.companies import company_specs
from reviewlake.sources.read import read_pages

from . import sql
from .inputs import (
    CALL,
    IS_CALL,
    OTHER_URL_SQL,
    PAGE_ID,
    POS,
    REVIEWS_SQL,
    SITE_URL_SQL,
    cores,
    harvest_list,
    other_pages,
    site_pages,
    table,
    wide_table,
)
from .labels import _first_letter_labeler
from .scalars import INCREMENT_SQL

_ROWS_SQL = f"""select ord, source, review_id, {sql.normalize('title')} as title,
  case when {IS_CALL} then '{CALL}' else {sql.normalize('body')} end as body, rating, author,
  date_published, location from ({REVIEWS_SQL}) r"""
_FIELDS = "review_id, title, body, rating, author, date_published, location, source_url"
_NOT_EMPTY = sql.not_empty("title", "body", "rating", "author", "date_published")

# What each way of reading a page gives for a review.
_STRUCTURED_SQL = f"""select ord, source, review_id, title, body, rating, author, date_published,
  cast(null as varchar) as location, {SITE_URL_SQL} as source_url, {PAGE_ID} as page_id,
  0 as source_rank, {POS} as place from ({_ROWS_SQL}) s where not {IS_CALL}"""
_SITE_SQL = f"""select ord, source, review_id, case when not {IS_CALL} then title end as title,
  case when not {IS_CALL} then body end as body, rating, author, date_published, location,
  {SITE_URL_SQL} as source_url, {PAGE_ID} as page_id, 1 as source_rank, {POS} as place
  from ({_ROWS_SQL}) s"""
# Without a title of its own the first name inside the block is the author's, and
# without a time the text of its element is the date.
_GENERIC_SQL = f"""select ord, source, review_id, coalesce(title, author) as title, body, rating,
  author, case when date_published = '' then '-' else date_published end as date_published,
  location, {OTHER_URL_SQL} as source_url, {PAGE_ID} as page_id, {POS} as place
  from ({_ROWS_SQL}) s where not {IS_CALL}"""
_BOTH_SQL = f"select * from ({_STRUCTURED_SQL}) a union all select * from ({_SITE_SQL}) b"


def _found(rows, *more):
    return rows.select(*_FIELDS.split(", "), *more)


def structured_payloads(spark, sf_dir):
    payloads = X.jsonld_payloads(site_pages(spark, sf_dir))
    return payloads.select("page_id", "script", F.size("nodes").cast("bigint").alias("n_objects"))


def structured_objects(spark, sf_dir):
    objects = X.json_objects(X.jsonld_payloads(site_pages(spark, sf_dir)))
    return objects.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def structured_reviews(spark, sf_dir):
    return _found(X.jsonld_reviews(site_pages(spark, sf_dir)), "page_id")


def site_markup_reviews(spark, sf_dir):
    return _found(X.site_markup_reviews(site_pages(spark, sf_dir)), "page_id")


def generic_markup_reviews(spark, sf_dir):
    return _found(X.generic_markup_reviews(other_pages(spark, sf_dir)), "page_id")


def extract_reviews(spark, sf_dir):
    pages = site_pages(spark, sf_dir).unionByName(other_pages(spark, sf_dir))
    return _found(X.extract_reviews(pages), "source_rank")


def reviews_in_raw_pages(spark, sf_dir):
    """A review block inside each of the given, badly marked-up pages."""
    block = F.concat(
        F.lit("<section data-review-id='r"),
        F.col("page_id"),
        F.lit("'><h3>"),
        F.concat(F.lit("Autor "), F.col("page_id")),
        F.lit("<p>Uno &amp; <i>dos</i><b>tres</section>"),
    )
    pages = read_pages(spark, f"{sf_dir}/pages.parquet", cores(spark)).withColumn(
        "html", F.concat(F.replace("html", F.lit("<footer>"), F.concat(block, F.lit("<footer>"))), block)
    )
    return X.site_markup_reviews(pages).select("page_id", "review_id", "author", "body")


def next_page(spark, sf_dir):
    return X.next_page_url(read_pages(spark, f"{sf_dir}/pages.parquet", cores(spark))).select("page_id", "next_url")


def next_page_linked(spark, sf_dir):
    link = F.expr(
        """case when page_id % 3 = 0 then concat('<a rel="nofollow Next" href="/p/', page_id, '">x</a>')
        when page_id % 3 = 1 then concat('<a href="/q/', page_id, '"><b>Siguiente &raquo;</b></a>')
        else concat('<a href="/r/', page_id, '">a</a><a href="/s/', page_id, '">Older</a>') end"""
    )
    pages = read_pages(spark, f"{sf_dir}/pages.parquet", cores(spark)).withColumn("html", F.concat("html", link))
    return X.next_page_url(pages).select("page_id", "next_url")


_LINK = """select page_id, concat('https://x.example/p/', cast(page_id as string)) as url,
  case when page_id % 10 = 9 then concat('https://x.example/p/', cast(page_id - 9 as string))
       when page_id % 10 = 4 and page_id % 3 = 0 then 'https://x.example/gone'
       else concat('https://x.example/p/', cast(page_id + 1 as string)) end as next_url
  from {pages}"""


def page_chains(spark, sf_dir):
    links = spark.sql(_LINK, pages=table(spark, sf_dir, "pages"))
    starts = links.where("page_id % 10 = 0").select(F.col("url").alias("start"))
    return page_chain(links, starts, 8)


def fallback_source(spark, sf_dir):
    """Companies whose pages lack structured data get their markup reviews."""
    pages = site_pages(spark, sf_dir)
    without = F.regexp_replace("html", "application/ld", "text/x")
    pages = materialize(
        pages.withColumn("html", F.when(F.expr("page_id % 20 % 4 = 0"), without).otherwise(F.col("html")))
    )
    structured = X.jsonld_reviews(pages).withColumn("company", _company())
    markup = X.site_markup_reviews(pages).withColumn("company", _company())
    return _found(X.with_fallback(structured, markup), "company")


def _company():
    return F.regexp_extract("source_url", r"/review/(\w+)", 1)


def _harvest(spark, sf_dir, max_reviews=None):
    specs = company_specs(harvest_list(spark, sf_dir), order_col="doc_id")
    return harvest(site_pages(spark, sf_dir), specs, max_reviews=max_reviews)


def harvest_companies(spark, sf_dir):
    return _found(_harvest(spark, sf_dir), "company", "page_seq")


def harvest_capped(spark, sf_dir):
    return _found(_harvest(spark, sf_dir, max_reviews=3), "company")


def harvest_other_site(spark, sf_dir):
    """Companies given by the URL of their page on another site."""
    listed = (
        table(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(F.min("doc_id").alias("doc_id"))
        .selectExpr(
            "source as company",
            "concat('https://reviews.example.com/review/', source, '.example?page=1') as url",
            "doc_id",
        )
    )
    specs = company_specs(listed, order_col="doc_id")
    return _found(harvest(other_pages(spark, sf_dir), specs), "company")


def harvest_rendered(spark, sf_dir):
    """A second snapshot, of markup only, for companies the first one lacks."""
    pages = materialize(site_pages(spark, sf_dir))
    first = pages.where("page_id % 20 % 4 <> 0")
    second = pages.withColumn("html", F.regexp_replace("html", "application/ld", "text/x"))
    specs = company_specs(harvest_list(spark, sf_dir), order_col="doc_id")
    return _found(harvest(first, specs, rendered=second), "company")


def harvest_failures(spark, sf_dir):
    """Companies without a page, and pages without HTML."""
    specs = company_specs(harvest_list(spark, sf_dir), order_col="doc_id")
    pages = site_pages(spark, sf_dir).withColumn("html", F.expr("case when page_id % 7 <> 0 then html end"))
    return flow.harvest_failures(pages, specs)


def deep_reviews(spark, sf_dir):
    """Reviews below a thousand other elements, and inside a thousand of their own."""
    deep = lambda tag, n: F.repeat(F.lit(tag), F.lit(n))
    html = F.concat(
        deep("<div>", 1000),
        F.lit("<article data-review-id='r"),
        F.col("page_id"),
        F.lit("'>"),
        deep("<section>", 1000),
        F.concat(F.lit("<p>Cuerpo "), F.col("page_id"), F.lit("</p>")),
        deep("</section>", 1000),
        F.lit("<time datetime='2024'></time></article>"),
        deep("</div>", 1000),
    )
    pages = wide_table(spark, sf_dir, "pages", "page_id").withColumn("html", html)
    return X.site_markup_reviews(pages).select("page_id", "review_id", "body", "date_published")


def harvest_cleaned(spark, sf_dir):
    order = ["company", "page_seq", "source_rank", "pos"]
    return _found(clean_reviews(combine(_harvest(spark, sf_dir)), order), "company")


def test_run(spark, sf_dir):
    """The flow's test mode: three reviews per company, three rows labeled, no load."""
    specs = company_specs(harvest_list(spark, sf_dir), order_col="doc_id")
    labeled = run(
        site_pages(spark, sf_dir), specs, _first_letter_labeler, "none", test_mode=True, first_pause=0.0
    )
    return labeled.select("review_id", "review", "company")


def full_run(spark, sf_dir):
    """Pages to the loaded table of classified reviews."""
    path = scratch_dir(spark)
    name = "classified_" + path.rsplit("-", 1)[1]
    specs = company_specs(harvest_list(spark, sf_dir), order_col="doc_id")
    loaded = run(
        site_pages(spark, sf_dir), specs, _first_letter_labeler, name, table_path=path, first_pause=0.0
    )
    return loaded.select(
        "review_id", "review", "sentiment_label", "company", F.col("error").isNotNull().alias("failed")
    )


def _harvest_sql(rows: str, rank: str = "source_rank") -> str:
    return f"""select *, cast(floor(ord / 200) as int) as page_seq from (
      select *, row_number() over (partition by source, {sql.fingerprint('review_id', 'author', 'body')}
        order by floor(ord / 200), {rank}, place) as rn from ({rows}) b where {_NOT_EMPTY}) k
      where rn = 1"""


def _cleaned_sql(rows: str) -> str:
    return f"""select * from (select *, upper(concat(source, '.example')) as company,
        row_number() over (partition by review_id
          order by upper(concat(source, '.example')), page_seq, source_rank, place) as rk
      from ({rows}) h where review_id is not null) c where rk = 1"""


_HARVEST_SQL = _harvest_sql(_BOTH_SQL)
_CLEANED_SQL = _cleaned_sql(_HARVEST_SQL)
_CAPPED_SQL = f"""select * from (
  select *, row_number() over (partition by source order by page_seq, source_rank, place) as nth
  from ({_HARVEST_SQL}) h) c where nth <= 3"""
_LACKING = "cast(substring(source, 4) as int) % 4 = 0"

QUERIES = {
    "structured_payloads": (
        structured_payloads,
        f"""select {PAGE_ID} as page_id, 0 as script, 1 + 3 * count(*) as n_objects
        from ({REVIEWS_SQL}) r group by 1""",
    ),
    "structured_objects": (
        structured_objects,
        f"""select 'Review' as type, count(*) as n from ({REVIEWS_SQL}) r
        union all select 'Person', count(*) from ({REVIEWS_SQL}) r
        union all select null, count(*) + count(distinct {PAGE_ID}) from ({REVIEWS_SQL}) r""",
    ),
    "structured_reviews": (
        structured_reviews,
        f"select {_FIELDS}, page_id from ({_STRUCTURED_SQL}) s where {_NOT_EMPTY}",
    ),
    "site_markup_reviews": (
        site_markup_reviews,
        f"select {_FIELDS}, page_id from ({_SITE_SQL}) s where {_NOT_EMPTY}",
    ),
    "generic_markup_reviews": (
        generic_markup_reviews,
        f"select {_FIELDS}, page_id from ({_GENERIC_SQL}) s where {_NOT_EMPTY}",
    ),
    "extract_reviews": (
        extract_reviews,
        f"""select {_FIELDS}, source_rank from ({_BOTH_SQL}) b where {_NOT_EMPTY}
        union all select {_FIELDS}, 1 from ({_GENERIC_SQL}) g where {_NOT_EMPTY}""",
    ),
    "reviews_in_raw_pages": (
        reviews_in_raw_pages,
        """select page_id, concat('r', cast(page_id as string)) as review_id,
          concat('Autor ', cast(page_id as string)) as author, 'Uno & dos tres' as body
        from (select page_id from pages where contains(html, '<footer>') union all select page_id from pages) p""",
    ),
    # No link of the given pages leads on, so the page number does.
    "next_page": (next_page, INCREMENT_SQL),
    "next_page_linked": (
        next_page_linked,
        """select page_id, concat(regexp_extract(url, '^([a-z]+://[^/]*)', 1),
          case page_id % 3 when 0 then '/p/' when 1 then '/q/' else '/s/' end,
          cast(page_id as string)) as next_url from pages""",
    ),
    "page_chains": (
        page_chains,
        f"""with recursive links as ({_LINK.format(pages='pages')}),
        chain(start, url, page_seq) as (
          select url, url, 0 from links where page_id % 10 = 0
          union all
          select c.start, l.next_url, c.page_seq + 1 from chain c join links l on c.url = l.url
          where c.page_seq < 7 and l.next_url in (select url from links))
        select start, url, min(page_seq) as page_seq from chain group by 1, 2""",
    ),
    "fallback_source": (
        fallback_source,
        f"""select {_FIELDS}, source as company from ({_STRUCTURED_SQL}) a
        where {_NOT_EMPTY} and cast(substring(source, 4) as int) % 4 <> 0
        union all select {_FIELDS}, source from ({_SITE_SQL}) b
        where {_NOT_EMPTY} and cast(substring(source, 4) as int) % 4 = 0""",
    ),
    "harvest_companies": (
        harvest_companies,
        f"select {_FIELDS}, concat(source, '.example') as company, page_seq from ({_HARVEST_SQL}) h",
    ),
    "harvest_capped": (
        harvest_capped,
        f"select {_FIELDS}, concat(source, '.example') as company from ({_CAPPED_SQL}) c",
    ),
    "harvest_other_site": (
        harvest_other_site,
        f"select {_FIELDS}, source as company from ({_harvest_sql(_GENERIC_SQL, '0')}) h",
    ),
    "harvest_rendered": (
        harvest_rendered,
        f"""select {_FIELDS}, concat(source, '.example') as company from ({_HARVEST_SQL}) a
        where not {_LACKING}
        union all select {_FIELDS}, concat(source, '.example') from ({_harvest_sql(_SITE_SQL)}) b
        where {_LACKING}""",
    ),
    "harvest_failures": (
        harvest_failures,
        # A page without HTML has no link, so its number leads on.
        f"""select concat(source, '.example') as company, url, 'no HTML' as error
        from (select distinct source, {SITE_URL_SQL} as url, {PAGE_ID} as page from ({REVIEWS_SQL}) r) p
        where page % 7 = 0
        union all select 'sin-paginas.example',
          'https://es.trustpilot.com/review/sin-paginas.example', 'no page'""",
    ),
    "deep_reviews": (
        deep_reviews,
        """select page_id, concat('r', cast(page_id as string)) as review_id,
          concat('Cuerpo ', cast(page_id as string)) as body, '2024' as date_published from pages""",
    ),
    "test_run": (
        test_run,
        f"""select review_id, body as review, company from (
          select * from ({_cleaned_sql(_CAPPED_SQL)}) c
          order by company, page_seq, source_rank, place limit 3) t
        where coalesce(body, '') <> ''""",
    ),
    "harvest_cleaned": (
        harvest_cleaned,
        f"select {_FIELDS}, company from ({_CLEANED_SQL}) c",
    ),
    "full_run": (
        full_run,
        f"""select review_id, body as review, case when failed then null
          when substring(body, 1, 1) in ('A','E','I','O','U','a','e','i','o','u') then 'Positiva'
          else 'Negativa' end as sentiment_label, company, failed
        from (select *, length(body) % 7 = 0 as failed from ({_CLEANED_SQL}) c
              where coalesce(body, '') <> '') s""",
    ),
}
