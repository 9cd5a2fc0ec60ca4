"""The list of companies to harvest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text, urls
from ..operators.dedup import dedup_last
from ..operators.filters import drop_blank_company, first_given
from ..operators.project import empresa_display_name, pick_column, trim_headers

# Recognised column names, best first.
URL_COLUMNS = ["trustpilot_url", "url", "link", "enlace", "pagina", "página"]
COMPANY_COLUMNS = ["company", "empresa", "nombre", "name", "dominio", "domain"]


def company_specs(
    df: DataFrame,
    company_col: str | None = None,
    url_col: str | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """``company, company_or_url, ord`` of a company list with any headers.

    A URL wins over a name, rows without either are dropped, and of rows for
    the same URL or name the last one counts. ``order_col`` gives the order of
    the rows; without it the order of the file is taken.
    """
    df = trim_headers(df)
    names = [c for c in df.columns if c != order_col]
    url_col = url_col or pick_column(names, URL_COLUMNS)
    company_col = company_col or pick_column(names, COMPANY_COLUMNS)
    if not url_col and not company_col:
        company_col = names[0]
    none = F.lit(None).cast("string")
    order = F.col(f"`{order_col}`") if order_col else F.monotonically_increasing_id()
    raw = df.select(
        (F.col(f"`{company_col}`").cast("string") if company_col else none).alias("company"),
        (F.col(f"`{url_col}`").cast("string") if url_col else none).alias("url"),
        order.alias("ord"),
    )
    company_or_url = first_given(F.col("url"), F.col("company"))
    specs = drop_blank_company(raw, "company", "url").select(
        empresa_display_name(F.col("company"), company_or_url).alias("company"),
        company_or_url.alias("company_or_url"),
        "ord",
    )
    return dedup_last(specs)


def with_start(specs: DataFrame) -> DataFrame:
    """Adds the ``start`` URL and the file ``slug`` of each company."""
    return specs.withColumns(
        {
            "start": urls.review_url(F.col("company_or_url")),
            "slug": text.slugify_company(F.col("company")),
        }
    )
