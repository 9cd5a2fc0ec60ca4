"""Projections, filters, duplicates, unions and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import dedup, filters, project
from reviewlake.plans.flow import clean_reviews
from reviewlake.sources.companies import company_specs
from reviewlake.sources.read import require_columns

from . import sql
from .inputs import (
    CALL,
    CLASSIFIED_SQL,
    COMPANY_LIST_SQL,
    IS_CALL,
    REVIEWS_SQL,
    classified,
    company_list,
    reviews,
    table,
    with_calls,
)
from .reports import SPECS_SQL

REVIEW_FIELDS = "review_id, title, body, rating, author, date_published, location, source_url"

# Reviews some of which say nothing at all.
_SPARSE = [
    "ord",
    "case when ord % 3 = 0 then null else title end as title",
    "case when ord % 4 < 3 then '' else body end as body",
    "rating",
    "case when ord % 5 > 0 then null else author end as author",
    "date_published",
]
_CALLS_SQL = f"""select ord, title, case when {IS_CALL} then '{CALL}' else body end as body
  from ({REVIEWS_SQL}) r"""


def to_review(spark, sf_dir):
    return project.to_review(reviews(spark, sf_dir))


def passthrough(spark, sf_dir):
    return project.passthrough(reviews(spark, sf_dir).drop("location"))


def trim_headers(spark, sf_dir):
    return project.trim_headers(company_list(spark, sf_dir)).withColumnsRenamed(
        {"Empresa": "empresa", "Enlace": "enlace"}
    )


def timestamps_naive(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return project.make_timestamps_naive(events.select("event_id", "ts", "value"))


def enrich(spark, sf_dir):
    rows = classified(spark, sf_dir)
    labels = F.struct("sentiment_label", "general_category", "specific_category", "error")
    return project.enrich(rows.withColumn("_l", labels), F.col("_l"))


def required_columns(spark, sf_dir):
    return require_columns(reviews(spark, sf_dir), ["review_id", "body"]).select("ord", "review_id")


def drop_sample(spark, sf_dir):
    return filters.drop_sample(reviews(spark, sf_dir)).select("ord", "company")


def drop_missing_id(spark, sf_dir):
    return filters.drop_missing_id(reviews(spark, sf_dir)).select("ord", "review_id")


def prune_empty(spark, sf_dir):
    rows = reviews(spark, sf_dir).selectExpr(*_SPARSE)
    return filters.prune_empty(rows)


def cta_drop(spark, sf_dir):
    rows = with_calls(reviews(spark, sf_dir)).select("ord", "title", "body")
    return filters.cta_drop(rows)


def cta_blank(spark, sf_dir):
    rows = with_calls(reviews(spark, sf_dir)).select("ord", "title", "body")
    return filters.cta_blank(rows)


def drop_blank_text(spark, sf_dir):
    return filters.drop_blank_text(reviews(spark, sf_dir)).select("ord", "body")


def drop_blank_company(spark, sf_dir):
    rows = project.trim_headers(company_list(spark, sf_dir))
    return filters.drop_blank_company(rows, "Empresa", "Enlace").select("doc_id")


def list_companies(spark, sf_dir):
    return company_specs(company_list(spark, sf_dir), order_col="doc_id")


def dedup_last(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), "o_orderpriority").alias("company_or_url"),
        "o_custkey",
        F.col("o_orderkey").alias("ord"),
    )
    return dedup.dedup_last(rows)


def dedup_by_fingerprint(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    return dedup.dedup_by_fingerprint(rows, ["ord"]).select("company", "review_id", "body", "ord")


def dedup_by_id(spark, sf_dir):
    rows = filters.drop_missing_id(reviews(spark, sf_dir))
    return dedup.dedup_by_id(rows, ["company", "ord"]).select("review_id", "company", "ord")


def cleaned_reviews(spark, sf_dir):
    cleaned = clean_reviews(reviews(spark, sf_dir), ["company", "ord"])
    return cleaned.selectExpr(*REVIEW_FIELDS.split(", "), "company")


def union_outer(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    negative = rows.where("quality = 0").select("ord", "body", "company")
    positive = rows.where("quality = 1").select("ord", "company", "rating")
    unlabeled = rows.where("quality is null").select("location", "ord")
    return dedup.union_outer([negative, positive, unlabeled])


def cap_per_company(spark, sf_dir):
    return dedup.cap_per_company(reviews(spark, sf_dir), 3, ["ord"]).select("company", "ord", "body")


def cap_per_type_large(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dedup.cap_per_company(events, 1500, ["event_id"], ["event_type"]).select(
        "event_type", "event_id", "value"
    )


def head(spark, sf_dir):
    return dedup.head(reviews(spark, sf_dir), 3, ["ord"]).select("ord", "body")


def head_large(spark, sf_dir):
    return dedup.head(table(spark, sf_dir, "lineitem").withColumns(
        {"place": F.col("l_orderkey") * 8 + F.col("l_linenumber")}
    ).select("place", "l_partkey"), 40_000, ["place", "l_partkey"])


def head_by_text(spark, sf_dir):
    """An order of text columns, of which the first has few values."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag", "cast(l_orderkey * 8 + l_linenumber as string) as place", "l_quantity"
    )
    return dedup.head(rows, 5000, ["l_returnflag", "place", "l_quantity"])


def cap_per_mode(spark, sf_dir):
    """A large limit per group, in an order of sparse numbers."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag", "(l_orderkey * 8 + l_linenumber) * 1000003 as place", "l_quantity"
    )
    return dedup.cap_per_company(rows, 1000, ["place", "l_quantity"], ["l_returnflag"])


def limit_pages(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn("page_seq", F.expr("cast(ord / 200 as int)"))
    return dedup.limit_pages(rows, 2).select("ord", "page_seq")


QUERIES = {
    "to_review": (to_review, f"select {REVIEW_FIELDS} from ({REVIEWS_SQL}) r"),
    "passthrough": (
        passthrough,
        f"""select author, rating, date_published, source_url, title, company
        from ({REVIEWS_SQL}) r""",
    ),
    "trim_headers": (trim_headers, COMPANY_LIST_SQL),
    "timestamps_naive": (timestamps_naive, "select event_id, ts, value from events"),
    "enrich": (
        enrich,
        f"""select review_id, {sql.strip('body')} as review, sentiment_label, general_category,
          specific_category, author, rating, date_published, location, source_url, title, company,
          error from ({CLASSIFIED_SQL}) c""",
    ),
    "required_columns": (required_columns, f"select ord, review_id from ({REVIEWS_SQL}) r"),
    "drop_sample": (
        drop_sample,
        f"select ord, company from ({REVIEWS_SQL}) r where company is distinct from 'SAMPLE'",
    ),
    "drop_missing_id": (
        drop_missing_id,
        f"select ord, review_id from ({REVIEWS_SQL}) r where review_id is not null",
    ),
    "prune_empty": (
        prune_empty,
        f"""select * from (select {', '.join(_SPARSE)} from ({REVIEWS_SQL}) r) s
        where {sql.not_empty('title', 'body', 'rating', 'author', 'date_published')}""",
    ),
    "cta_drop": (
        cta_drop,
        f"select * from ({_CALLS_SQL}) c where not {sql.is_call('title', 'body')}",
    ),
    "cta_blank": (
        cta_blank,
        f"""select ord, case when not {sql.is_call('title', 'body')} then title end as title,
          case when not {sql.is_call('title', 'body')} then body end as body
        from ({_CALLS_SQL}) c""",
    ),
    "drop_blank_text": (
        drop_blank_text,
        f"select ord, body from ({REVIEWS_SQL}) r where {sql.strip('body')} <> ''",
    ),
    "drop_blank_company": (
        drop_blank_company,
        f"""select doc_id from ({COMPANY_LIST_SQL}) l
        where coalesce(nullif({sql.strip('enlace')}, ''), nullif({sql.strip('empresa')}, '')) is not null""",
    ),
    "list_companies": (list_companies, SPECS_SQL),
    "dedup_last": (
        dedup_last,
        """select max_by(concat(' ', o_orderpriority), o_orderkey) as company_or_url,
          max_by(o_custkey, o_orderkey) as o_custkey, min(o_orderkey) as ord
        from orders group by lower(o_orderpriority)""",
    ),
    "dedup_by_fingerprint": (
        dedup_by_fingerprint,
        f"""select company, review_id, body, ord from (
          select *, row_number() over (partition by company,
            {sql.fingerprint('review_id', 'author', 'body')} order by ord) as rn
          from ({REVIEWS_SQL}) r) k where rn = 1""",
    ),
    "dedup_by_id": (
        dedup_by_id,
        f"""select review_id, company, ord from (
          select *, row_number() over (partition by review_id order by company, ord) as rn
          from ({REVIEWS_SQL}) r where review_id is not null) k where rn = 1""",
    ),
    "cleaned_reviews": (
        cleaned_reviews,
        f"""select {REVIEW_FIELDS}, company from (
          select *, row_number() over (partition by review_id order by company, ord) as rn
          from ({REVIEWS_SQL}) r where review_id is not null and company <> 'SAMPLE') k
        where rn = 1""",
    ),
    "union_outer": (
        union_outer,
        f"""select ord, case when quality = 0 then body end as body,
          case when quality is not null then company end as company,
          case when quality = 1 then rating end as rating,
          case when quality is null then location end as location from ({REVIEWS_SQL}) r""",
    ),
    "cap_per_company": (
        cap_per_company,
        f"""select company, ord, body from (
          select *, row_number() over (partition by company order by ord) as rn
          from ({REVIEWS_SQL}) r) k where rn <= 3""",
    ),
    "cap_per_type_large": (
        cap_per_type_large,
        """select event_type, event_id, value from (
          select *, row_number() over (partition by event_type order by event_id) as rn
          from events) k where rn <= 1500""",
    ),
    "head": (head, f"select ord, body from ({REVIEWS_SQL}) r order by ord limit 3"),
    "head_large": (
        head_large,
        """select l_orderkey * 8 + l_linenumber as place, l_partkey from lineitem
        order by l_orderkey, l_linenumber, l_partkey limit 40000""",
    ),
    "head_by_text": (
        head_by_text,
        """select l_returnflag, cast(l_orderkey * 8 + l_linenumber as varchar) as place, l_quantity
        from lineitem order by l_returnflag, place, l_quantity limit 5000""",
    ),
    "cap_per_mode": (
        cap_per_mode,
        """select l_returnflag, place, l_quantity from (
          select l_returnflag, (l_orderkey * 8 + l_linenumber) * 1000003 as place, l_quantity,
            row_number() over (partition by l_returnflag order by l_orderkey, l_linenumber, l_quantity) as rn
          from lineitem) k where rn <= 1000""",
    ),
    "limit_pages": (
        limit_pages,
        f"""select ord, cast(floor(ord / 200) as int) as page_seq from ({REVIEWS_SQL}) r
        where floor(ord / 200) < 2""",
    ),
}
