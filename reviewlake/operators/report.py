"""The dashboard's aggregates. All combine partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# Fixed values.
POSITIVE = "Positiva"
NEGATIVE = "Negativa"

LEVELS = {"general": "general_category", "specific": "specific_category"}


def sentiment_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and share per sentiment."""
    n = df.groupBy(*by, "sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return n.withColumn("share", F.col("n") / total)


def category_counts(df: DataFrame, level: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per general or specific category."""
    return df.groupBy(*by, LEVELS[level]).agg(F.count(F.lit(1)).alias("n"))


def top_categories(df: DataFrame, level: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent categories, by name where counts are equal."""
    w = Window.partitionBy(*by).orderBy(F.desc("n"), LEVELS[level])
    return (
        category_counts(df.where(F.col(LEVELS[level]).isNotNull()), level, by)
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
    )


def category_drilldown(df: DataFrame) -> DataFrame:
    """General categories into specific ones, with subtotals and total."""
    return df.rollup("general_category", "specific_category").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level")
    )


def company_scorecard(df: DataFrame) -> DataFrame:
    """Rows, share of positive labels, mean rating and failed rows per company."""
    positive = F.when(F.col("sentiment_label").isNotNull(),
                      (F.col("sentiment_label") == POSITIVE).cast("double"))
    return df.groupBy("company").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(positive).alias("positive_share"),
        F.avg("rating").alias("mean_rating"),
        F.count_if(F.col("error").isNotNull()).alias("n_errors"),
    )


def company_by_sentiment(df: DataFrame) -> DataFrame:
    """One column of counts per sentiment."""
    return (
        df.groupBy("company")
        .pivot("sentiment_label", [POSITIVE, NEGATIVE])
        .agg(F.count(F.lit(1)))
        .na.fill(0, [POSITIVE, NEGATIVE])
    )


def company_cube(df: DataFrame) -> DataFrame:
    """All subtotals of company, sentiment and general category."""
    return df.cube("company", "sentiment_label", "general_category").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level")
    )


def profile(df: DataFrame) -> DataFrame:
    """Per company: rows, rows without id, repeated ids, and rows that remain.

    ``n_anonymous`` counts the rows without id, author and body, which all share
    one fingerprint.
    """
    per_id = df.groupBy("company", "review_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(
            (F.coalesce(F.col("review_id"), F.lit("")) == "")
            & (F.coalesce(F.col("author"), F.lit("")) == "")
            & (F.coalesce(F.col("body"), F.lit("")) == "")
        ).alias("n_anonymous"),
    )
    has_id = F.col("review_id").isNotNull()
    return per_id.groupBy("company").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(~has_id, F.col("n")).otherwise(0)).alias("n_missing_id"),
        F.sum(F.when(has_id, F.col("n") - 1).otherwise(0)).alias("n_duplicates"),
        F.count_if(has_id).alias("n_kept"),
        F.sum("n_anonymous").alias("n_anonymous"),
    )


def company_inventory(df: DataFrame) -> DataFrame:
    """The companies seen."""
    return df.select("company").distinct()


def harvest_coverage(specs: DataFrame, reviews: DataFrame) -> DataFrame:
    """Listed companies with their number of reviews; 0 for those without any.

    Both tables have a ``slug``.
    """
    n = reviews.groupBy("slug").agg(F.count(F.lit(1)).alias("n_reviews"))
    return specs.join(n, "slug", "left").na.fill(0, ["n_reviews"])
