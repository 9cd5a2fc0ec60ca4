"""The dashboard's queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import report
from reviewlake.operators.filters import explore
from reviewlake.plans.flow import clean_reviews
from reviewlake.sources.companies import company_specs, with_start

from . import sql
from .inputs import (
    CLASSIFIED,
    CLASSIFIED_SQL,
    COMPANY_LIST_SQL,
    REVIEWS_SQL,
    classified,
    company_list,
    reviews,
)

_CLEAN_SQL = f"""select * from (
  select *, row_number() over (partition by review_id order by company, ord) as rn
  from ({CLASSIFIED_SQL}) c where company <> 'SAMPLE' and review_id is not null) k
where rn = 1"""


def _clean(spark, sf_dir):
    # Cleaned first: the labels of a row that goes are not needed.
    cleaned = clean_reviews(reviews(spark, sf_dir), ["company", "ord"])
    return spark.sql(CLASSIFIED, reviews=cleaned)


def sentiment_by_company(spark, sf_dir):
    return report.sentiment_distribution(_clean(spark, sf_dir), ["company"])


def sentiment_distribution(spark, sf_dir):
    return report.sentiment_distribution(classified(spark, sf_dir))


def category_counts_general(spark, sf_dir):
    return report.category_counts(classified(spark, sf_dir), "general", ["company"])


def category_counts_specific(spark, sf_dir):
    return report.category_counts(classified(spark, sf_dir), "specific", ["sentiment_label"])


def top_categories(spark, sf_dir):
    return report.top_categories(classified(spark, sf_dir), "specific", 2, ["company"])


def category_drilldown(spark, sf_dir):
    return report.category_drilldown(classified(spark, sf_dir))


def company_scorecard(spark, sf_dir):
    return report.company_scorecard(classified(spark, sf_dir))


def company_by_sentiment(spark, sf_dir):
    return report.company_by_sentiment(classified(spark, sf_dir))


def company_cube(spark, sf_dir):
    return report.company_cube(classified(spark, sf_dir))


def profile(spark, sf_dir):
    return report.profile(reviews(spark, sf_dir))


def company_inventory(spark, sf_dir):
    return report.company_inventory(reviews(spark, sf_dir))


def explore_reviews(spark, sf_dir):
    rows = explore(classified(spark, sf_dir), company="SRC7", sentiment="Positiva")
    return rows.select("ord", "review_id", "body", "general_category", "specific_category")


_REVIEWED = """case when cast(substring(source, 4) as int) % 3 = 0
  then concat(source, '-', location, '.example') else concat(source, '.example') end"""


def harvest_coverage(spark, sf_dir):
    specs = with_start(company_specs(company_list(spark, sf_dir), order_col="doc_id"))
    # The list has the sources; reviews are of sources and languages, so that some
    # companies have all of theirs under other names, and none of their own.
    found = reviews(spark, sf_dir).select(F.expr(_REVIEWED).alias("slug"))
    return report.harvest_coverage(specs, found).select("slug", "company_or_url", "n_reviews")


_NAME = f"nullif({sql.strip('empresa')}, '')"
_GIVEN = f"coalesce(nullif({sql.strip('enlace')}, ''), {_NAME})"
SPECS_SQL = f"""select max_by(company, doc_id) as company,
    max_by(company_or_url, doc_id) as company_or_url, min(doc_id) as ord
  from (select coalesce({_NAME}, {_GIVEN}) as company, {_GIVEN} as company_or_url, doc_id
        from ({COMPANY_LIST_SQL}) l) s
  where company_or_url is not null group by lower(company_or_url)"""

QUERIES = {
    "sentiment_by_company": (
        sentiment_by_company,
        f"""select company, sentiment_label, count(*) as n,
          count(*) * 1.0e0 / sum(count(*)) over (partition by company) as share
        from ({_CLEAN_SQL}) c group by 1, 2""",
    ),
    "sentiment_distribution": (
        sentiment_distribution,
        f"""select sentiment_label, count(*) as n, count(*) * 1.0e0 / sum(count(*)) over () as share
        from ({CLASSIFIED_SQL}) c group by 1""",
    ),
    "category_counts_general": (
        category_counts_general,
        f"select company, general_category, count(*) as n from ({CLASSIFIED_SQL}) c group by 1, 2",
    ),
    "category_counts_specific": (
        category_counts_specific,
        f"""select sentiment_label, specific_category, count(*) as n
        from ({CLASSIFIED_SQL}) c group by 1, 2""",
    ),
    "top_categories": (
        top_categories,
        f"""select * from (select company, specific_category, n,
          cast(row_number() over (partition by company order by n desc, specific_category) as int) as rank
        from (select company, specific_category, count(*) as n from ({CLASSIFIED_SQL}) c
              where specific_category is not null group by 1, 2) g) r where rank <= 2""",
    ),
    "category_drilldown": (
        category_drilldown,
        f"""select general_category, specific_category, count(*) as n,
          grouping_id(general_category, specific_category) as level
        from ({CLASSIFIED_SQL}) c group by rollup (general_category, specific_category)""",
    ),
    "company_scorecard": (
        company_scorecard,
        f"""select company, count(*) as n,
          avg(case when sentiment_label = 'Positiva' then 1.0e0
                   when sentiment_label is not null then 0.0e0 end) as positive_share,
          avg(rating) as mean_rating, count(error) as n_errors
        from ({CLASSIFIED_SQL}) c group by 1""",
    ),
    "company_by_sentiment": (
        company_by_sentiment,
        f"""select company, count(*) filter (sentiment_label = 'Positiva') as "Positiva",
          count(*) filter (sentiment_label = 'Negativa') as "Negativa"
        from ({CLASSIFIED_SQL}) c group by 1""",
    ),
    "company_cube": (
        company_cube,
        f"""select company, sentiment_label, general_category, count(*) as n,
          grouping_id(company, sentiment_label, general_category) as level
        from ({CLASSIFIED_SQL}) c group by cube (company, sentiment_label, general_category)""",
    ),
    "profile": (
        profile,
        f"""select company, count(*) as n_rows, count(*) - count(review_id) as n_missing_id,
          count(review_id) - count(distinct review_id) as n_duplicates,
          count(distinct review_id) as n_kept,
          count(*) filter (review_id is null and author is null and body = '') as n_anonymous
        from ({REVIEWS_SQL}) r group by 1""",
    ),
    "company_inventory": (
        company_inventory,
        f"select distinct company from ({REVIEWS_SQL}) r",
    ),
    "explore_reviews": (
        explore_reviews,
        f"""select ord, review_id, body, general_category, specific_category
        from ({CLASSIFIED_SQL}) c where company = 'SRC7' and sentiment_label = 'Positiva'""",
    ),
    "harvest_coverage": (
        harvest_coverage,
        f"""select s.slug, s.company_or_url, coalesce(n, 0) as n_reviews
        from (select {sql.slug('company')} as slug, company_or_url from ({SPECS_SQL}) x) s
        left join (select {_REVIEWED} as slug, count(*) as n from ({REVIEWS_SQL}) d group by 1) r
          on s.slug = r.slug""",
    ),
}
