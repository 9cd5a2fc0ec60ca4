"""Projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import text
from ..schema import LABEL_COLS, PASSTHROUGH_COLS, REVIEW_SCHEMA


def to_review(df: DataFrame) -> DataFrame:
    """The eight review fields, in their fixed order and types."""
    columns = {f.name: F.col(f.name).cast(f.dataType) for f in REVIEW_SCHEMA.fields}
    if isinstance(df.schema["rating"].dataType, T.StringType):
        columns["rating"] = text.rating_float(F.col("rating"))
    return df.select(*[c.alias(name) for name, c in columns.items()])


def passthrough(df: DataFrame, cols: Iterable[str] = PASSTHROUGH_COLS) -> DataFrame:
    """Those of ``cols`` the input has."""
    return df.select(*[c for c in cols if c in df.columns])


def pick_column(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """The column that matches the first matching candidate, case aside."""
    by_key = {c.strip().lower(): c for c in columns}
    return next((by_key[c.lower()] for c in candidates if c.lower() in by_key), None)


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def make_timestamps_naive(df: DataFrame) -> DataFrame:
    """Timestamps lose their zone and keep the session zone's wall clock."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in zoned})


def enrich(
    df: DataFrame,
    labels: Column,
    text_col: str = "body",
    id_col: str = "review_id",
) -> DataFrame:
    """The classified row: id, stripped text, labels, passed-through columns, error.

    ``labels`` is a struct of the three labels and ``error``.
    """
    review_id = F.col(id_col) if id_col in df.columns else F.lit(None).cast("string")
    kept = [c for c in PASSTHROUGH_COLS if c in df.columns]
    return df.select(
        review_id.alias("review_id"),
        text.strip(F.col(text_col)).alias("review"),
        *[labels[c].alias(c) for c in LABEL_COLS],
        *kept,
        labels["error"].alias("error"),
    )


def empresa_display_name(company: Column, company_or_url: Column) -> Column:
    return F.coalesce(text.blank_to_null(text.strip(company)), company_or_url)
