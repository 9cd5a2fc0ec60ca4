"""One query per scalar function."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.functions import text, urls
from reviewlake.operators import project
from reviewlake.operators.filters import first_given

from . import sql
from .inputs import (
    COMPANY_LIST_SQL,
    REVIEWS_SQL,
    company_list,
    reviews,
    table,
    wide_table,
)

NBSP = " "
_NOISY = f"concat('{NBSP} ', replace(replace(text, 'e ', 'e{NBSP}\t '), '. ', '. '), '\t ')"
_RAW_ID = """case when ord % 4 = 0
  then 'https://h.example/#/schema/Review/www.' || source || '.example/' || review_id
  when ord % 4 = 1 then source_url when ord % 4 = 2 then '' else review_id end"""
_NAME = f"""case when ord % 17 = 0 then ' {NBSP}' when ord % 5 = 0 then '._' || body || ' & Co. -'
  else ' ' || body || '\t' end"""
_START = """case when ord % 4 = 0 then source when ord % 4 = 1 then concat(' ', source, '.example ')
  when ord % 4 = 2 then source_url else '' end"""
_STARS = """case when ord % 5 = 0 then concat('Rated ', cast(ord % 6 as string), ' out of 5')
  when ord % 5 = 1 then concat(cast(ord % 5 as string), '.5/5')
  when ord % 5 = 2 then concat('Valorado con ', cast(ord % 6 as string), '.25  OUT OF 10 ') when ord % 5 = 3 then body
  else concat(body, ' 4.5 / 5') end"""
_NUMBER = f"""case when ord % 8 = 0 then concat('{NBSP}', cast(ord % 6 as string), ' ')
  when ord % 8 = 1 then '4,5' when ord % 8 = 2 then '4.5d' when ord % 8 = 3 then '1e3'
  when ord % 8 = 4 then concat(cast(ord % 5 as string), '.5') when ord % 8 = 5 then ''
  when ord % 8 = 6 then body else concat('-.', cast(ord % 9 as string)) end"""


def _documents(expression, name):
    def run(spark, sf_dir):
        rows = wide_table(spark, sf_dir, "documents", "doc_id")
        return rows.selectExpr("doc_id", f"{_NOISY} as _raw").select(
            "doc_id", expression(F.col("_raw")).alias(name)
        )

    return run


def _reviews(raw, name, expression):
    def run(spark, sf_dir):
        rows = reviews(spark, sf_dir).selectExpr("ord", f"{raw} as _raw")
        return rows.select("ord", expression(F.col("_raw")).alias(name))

    return run


def _on_reviews(raw, name, oracle):
    return f"select ord, {oracle('raw')} as {name} from (select ord, {raw} as raw from ({REVIEWS_SQL}) r) s"


def upper_company(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.upper_company(F.concat_ws("-", "source", "lang")).alias("company")
    )


def company_from_path(spark, sf_dir):
    name = F.concat(F.lit("trustpilot_reviews_"), F.col("source"), F.lit("%20a+b.csv"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.company_from_path(name).alias("company")
    )


def company_from_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.company_from_url(F.col("url")).alias("by_host"),
        urls.company_from_url(
            F.concat(F.lit("https://u@es.example.com/Review/www."), F.col("page_id"), F.lit("?a=/review/b"))
        ).alias("by_path"),
    )


def is_site_host(spark, sf_dir):
    marked = F.replace(F.col("url"), F.lit("//blog."), F.lit("//es.TrustPilot.blog."))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.is_site_host(marked).alias("marked"),
        urls.is_site_host(F.concat("url", F.lit("/trustpilot.com"))).alias("in_path"),
    )


def increment_page(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.increment_page(F.col("url")).alias("next_url")
    )


def output_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.output_name(F.col("url")).alias("by_url"),
        urls.output_name(
            F.col("url"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("n "), "page_id"))
        ).alias("by_name"),
    )


def fingerprint(spark, sf_dir):
    return reviews(spark, sf_dir).select(
        "ord", text.fingerprint(F.col("review_id"), F.col("author"), F.col("body")).alias("fp")
    )


def rating_first_number(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.rating_first_number(F.col("text")).alias("number")
    )


def display_name(spark, sf_dir):
    rows = project.trim_headers(company_list(spark, sf_dir))
    given = first_given(F.col("Enlace"), F.col("Empresa"))
    return rows.select(
        "doc_id", project.empresa_display_name(F.col("Empresa"), given).alias("company")
    )


def resolve_url(spark, sf_dir):
    href = F.concat(F.lit("../p/"), F.col("page_id"), F.lit("?page=2"))
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.resolve_url(F.regexp_extract("url", "^([^?#]*)", 1), href).alias("resolved")
    )


INCREMENT_SQL = r"""
  select page_id, concat(base, '?',
    case when query = '' then 'page=2'
         when regexp_matches(query, '(^|&)page=') then
           concat('page=', cast(cast(regexp_extract(query, 'page=([0-9]+)', 1) as bigint) + 1 as string),
                  regexp_extract(query, 'page=[0-9]+(.*)$', 1))
         else concat(query, '&page=2') end,
    case when fragment = '' then '' else concat('#', fragment) end) as next_url
  from (select page_id, regexp_extract(url, '^([^?#]*)', 1) as base,
          regexp_extract(url, '\?([^#]*)', 1) as query,
          regexp_extract(url, '#(.*)$', 1) as fragment from pages) u"""

_RATING_OUT_OF = r"(?i)([0-9]+(?:\.[0-9]+)?)\s*(?:out of|/)\s*[0-9]+"

QUERIES = {
    "normalize_text": (
        _documents(text.normalize_text, "text"),
        f"select doc_id, {sql.normalize('raw')} as text from (select doc_id, {_NOISY} as raw from documents) d",
    ),
    "norm_text": (
        _documents(text.norm, "text"),
        f"select doc_id, {sql.norm('raw')} as text from (select doc_id, {_NOISY} as raw from documents) d",
    ),
    "clean_review_id": (
        _reviews(_RAW_ID, "review_id", text.clean_review_id),
        _on_reviews(
            _RAW_ID,
            "review_id",
            lambda x: f"coalesce(nullif(regexp_extract({x}, '/Review/[^/]+/([A-Za-z0-9]+)$', 1), ''), nullif({x}, ''))",
        ),
    ),
    "upper_company": (
        upper_company,
        "select doc_id, upper(concat_ws('-', source, lang)) as company from documents",
    ),
    "company_from_path": (
        company_from_path,
        "select doc_id, upper(concat(source, ' a+b')) as company from documents",
    ),
    "safe_filename": (
        _reviews(_NAME, "name", text.safe_filename_component),
        _on_reviews(_NAME, "name", sql.safe_component),
    ),
    "slugify_company": (
        _reviews(_NAME, "slug", text.slugify_company),
        _on_reviews(_NAME, "slug", sql.slug),
    ),
    "company_from_url": (
        company_from_url,
        f"""select page_id, {sql.company_from_url('url')} as by_host,
          cast(page_id as string) as by_path from pages""",
    ),
    "review_url": (
        _reviews(_START, "url", urls.review_url),
        _on_reviews(_START, "url", sql.review_url),
    ),
    "is_site_host": (
        is_site_host,
        "select page_id, contains(url, '//blog.') as marked, false as in_path from pages",
    ),
    "increment_page": (increment_page, INCREMENT_SQL),
    "output_name": (
        output_name,
        f"""select page_id, concat('trustpilot_reviews_', {sql.company_from_url('url')}, '.csv') as by_url,
          concat('trustpilot_reviews_', case when page_id % 2 = 0 then concat('n_', page_id)
            else {sql.company_from_url('url')} end, '.csv') as by_name from pages""",
    ),
    "rating_out_of": (
        _reviews(_STARS, "rating", text.rating_out_of),
        _on_reviews(
            _STARS, "rating", lambda x: f"try_cast(regexp_extract({x}, '{_RATING_OUT_OF}', 1) as double)"
        ),
    ),
    "rating_float": (
        _reviews(_NUMBER, "rating", text.rating_float),
        _on_reviews(_NUMBER, "rating", lambda x: f"try_cast({sql.strip(x)} as double)"),
    ),
    "rating_first_number": (
        rating_first_number,
        r"""select doc_id, try_cast(regexp_extract(text, '[0-9]+(\.[0-9]+)?') as double) as number
        from documents""",
    ),
    "fingerprint": (
        fingerprint,
        f"select ord, {sql.fingerprint('review_id', 'author', 'body')} as fp from ({REVIEWS_SQL}) r",
    ),
    "display_name": (
        display_name,
        f"""select doc_id, coalesce(nullif({sql.strip('empresa')}, ''),
          nullif({sql.strip('enlace')}, '')) as company from ({COMPANY_LIST_SQL}) l""",
    ),
    "resolve_url": (
        resolve_url,
        r"""select page_id, concat(regexp_extract(url, '^([a-z]+://[^/]*/)', 1),
          case when regexp_matches(url, '^[a-z]+://[^/]*/[^/]*/[^/?#]*/') then
            concat(regexp_extract(url, '^[a-z]+://[^/]*/([^/]*/)', 1)) else '' end,
          'p/', cast(page_id as string), '?page=2') as resolved from pages""",
    ),
}
