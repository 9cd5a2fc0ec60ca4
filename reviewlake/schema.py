"""Row layouts shared by all operators, and the mapping to warehouse types."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("author", T.StringType()),
        T.StructField("date_published", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("source_url", T.StringType()),
    ]
)
REVIEW_COLS = REVIEW_SCHEMA.fieldNames()

# "First one wins" needs an explicit order: page within the company's chain,
# structured data before markup, position within the page.
ORDER_COLS = ["page_seq", "source_rank", "pos"]

LABEL_COLS = ["sentiment_label", "general_category", "specific_category"]

# Columns carried through classification when the input has them, in this order.
PASSTHROUGH_COLS = [
    "author",
    "rating",
    "date_published",
    "location",
    "source_url",
    "title",
    "company",
]

CLASSIFIED_COLS = ["review_id", "review", *LABEL_COLS, *PASSTHROUGH_COLS, "error"]


def warehouse_type(dtype: T.DataType) -> T.DataType:
    """The warehouse column type for a Spark type; what has no counterpart is text."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, T.BooleanType):
        return T.BooleanType()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampType()
    return T.StringType()


def warehouse_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, warehouse_type(f.dataType)) for f in schema.fields]
    )
