"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text

# Fixed value: the company name that marks test data.
SAMPLE_COMPANY = "SAMPLE"


def drop_sample(df: DataFrame, name: str = SAMPLE_COMPANY) -> DataFrame:
    """Drop the test company; rows without a company stay."""
    return df.where(~F.col("company").eqNullSafe(F.lit(name)))


def drop_missing_id(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["review_id"])


def prune_empty(df: DataFrame) -> DataFrame:
    """Keep rows that say something; an empty text and a rating of 0 say nothing."""
    says = F.lit(False)
    for name in ["title", "body", "author", "date_published"]:
        says = says | (F.coalesce(F.col(name), F.lit("")) != "")
    return df.where(says | (F.coalesce(F.col("rating"), F.lit(0.0)) != 0))


def cta_drop(df: DataFrame) -> DataFrame:
    """Drop rows that are a call to write a review."""
    return df.where(~text.has_call_to_action(F.col("title"), F.col("body")))


def cta_blank(df: DataFrame) -> DataFrame:
    """Keep such rows, without their title and body."""
    is_call = text.has_call_to_action(F.col("title"), F.col("body"))
    return df.withColumns(
        {c: F.when(~is_call, F.col(c)) for c in ["title", "body"]}
    )


def drop_blank_text(df: DataFrame, col: str = "body") -> DataFrame:
    return df.where(text.strip(F.col(col)) != "")


def first_given(*cols: Column) -> Column:
    """The first of the columns that is not blank, stripped."""
    return F.coalesce(*[text.blank_to_null(text.strip(c)) for c in cols])


def drop_blank_company(df: DataFrame, company_col: str, url_col: str) -> DataFrame:
    return df.where(first_given(F.col(url_col), F.col(company_col)).isNotNull())


def explore(
    df: DataFrame,
    company: str | None = None,
    sentiment: str | None = None,
    general: str | None = None,
    specific: str | None = None,
) -> DataFrame:
    """The dashboard's filters, from a company down to single reviews."""
    wanted = {
        "company": company,
        "sentiment_label": sentiment,
        "general_category": general,
        "specific_category": specific,
    }
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df
