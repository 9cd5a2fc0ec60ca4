"""Files, tables and streams: what is written reads back the same."""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from reviewlake.functions import text
from reviewlake.operators import filters
from reviewlake.scratch import scratch_dir
from reviewlake.sources import read, write
from reviewlake.streaming import reviews as streams

from .inputs import CLASSIFIED_SQL, REVIEWS_SQL, classified, reviews, table
from .tables import REVIEW_FIELDS

_FIELDS = REVIEW_FIELDS.split(", ")
_BLANK = "''"


def _null_if_blank(names) -> str:
    return ", ".join(n if n == "rating" else f"nullif({n}, '') as {n}" for n in names)


def _table_name(path: str) -> str:
    return "reviews_" + path.rsplit("-", 1)[1]


def company_csv(spark, sf_dir):
    """One CSV folder per company, read back."""
    path = scratch_dir(spark)
    rows = reviews(spark, sf_dir).withColumn("slug", text.slugify_company(F.col("company")))
    write.write_company_csv(rows, path, ["ord"])
    return read.read_company_csv(spark, path)


def combined_csv(spark, sf_dir):
    """Combined reviews, written as CSV and read back."""
    path = scratch_dir(spark)
    write.write_combined(reviews(spark, sf_dir).select(*_FIELDS, "company"), path)
    back = read.read_combined(spark, path)
    return back.withColumn("rating", text.rating_float(F.col("rating")))


def review_folder(spark, sf_dir):
    """A folder of files with different columns; the company is in the files' names."""
    back = read.read_review_folder(spark, _review_files(spark, sf_dir, "ord"))
    return back.select(
        *[c for c in _FIELDS if c != "rating"],
        text.rating_float(F.col("rating")).alias("rating"),
        F.col("ord").cast("bigint"),
        F.regexp_extract("company", "^PART-", 0).alias("company"),
    )


def _review_files(spark, sf_dir, *more):
    """Review files of two layouts below one folder."""
    path = scratch_dir(spark)
    rows = reviews(spark, sf_dir).select(*_FIELDS, *more, "ord").select(*_FIELDS, *more, F.col("ord").alias("_at"))
    write.write_combined(rows.where("_at % 2 = 0").drop("_at"), path)
    without = rows.where("_at % 2 = 1").select(*more, "location", "body", "source_url", "review_id", "author")
    write.write_combined(without, path, mode="append")
    return path


def classified_parquet(spark, sf_dir):
    path = scratch_dir(spark)
    rows = classified(spark, sf_dir).select("ord", "review_id", "sentiment_label", "rating", "error")
    write.write_classified(rows, path, "parquet")
    return spark.read.parquet(path)


def table_replaced(spark, sf_dir):
    path = scratch_dir(spark)
    name = _table_name(path)
    rows = classified(spark, sf_dir)
    write.create_table_like(rows, name, path=path)
    write.load_table(rows.select("ord", "company", "quality", "rating", "error"), name, path)
    return read.read_table(spark, name)


def table_emptied(spark, sf_dir):
    """A loaded table with a path of its own, replaced by an empty one and appended to."""
    path = scratch_dir(spark)
    name = _table_name(path)
    rows = reviews(spark, sf_dir).select("ord", "company", "rating")
    write.load_table(rows, name, path)
    write.create_table_like(rows, name, replace=True, path=path)
    write.write_table(rows.where("ord % 2 = 1"), name, "append", path)
    return read.read_table(spark, name)


def table_appended(spark, sf_dir):
    path = scratch_dir(spark)
    name = _table_name(path)
    rows = reviews(spark, sf_dir).select("ord", "company", "rating")
    write.write_table(rows.where("ord % 2 = 0"), name, "fail", path)
    write.write_table(rows.where("ord % 2 = 1"), name, "append", path)
    return read.read_table(spark, name)


def rows_written(spark, sf_dir):
    """The number of rows reported by a write, per table written."""
    path = scratch_dir(spark)
    counted, rows = write.with_count(reviews(spark, sf_dir).select(*_FIELDS))
    write.write_combined(counted, path, "parquet")
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(rows.get["rows"]).cast("bigint").alias("n_reported")
    )


def warehouse_types(spark, sf_dir):
    """Timestamps, dates, decimals and nested values in their warehouse types."""
    orders = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("date").alias("day"),
        F.col("value").cast("decimal(12,2)").alias("value"),
        (F.col("user_id") > 10).alias("known"),
        F.col("user_id").cast("int").alias("user_id"),
        F.array("event_type").alias("kinds"),
    )
    return write.to_warehouse(orders)


def _review_stream(spark, sf_dir):
    # The stream has the documents as its source; the fields that need no
    # second table are made of it.
    source = table(spark, sf_dir, "documents")
    docs = spark.readStream.schema(source.schema).parquet(f"{sf_dir}/documents*.parquet")
    return docs.selectExpr(
        """case when doc_id % 37 = 0 then null when doc_id % 10 = 3 then cast(doc_id - 1 as string)
           else cast(doc_id as string) end as review_id""",
        "case when source = 'src0' then 'SAMPLE' else upper(source) end as company",
        "text as body",
    )


def stream_dedup(spark, sf_dir):
    path = scratch_dir(spark)
    rows = streams.clean_stream(_review_stream(spark, sf_dir))
    unique = streams.stream_dedup(rows).select("review_id")
    streams.stream_load(unique, _table_name(path), f"{path}-progress", f"{path}-rows").awaitTermination()
    return read.read_table(spark, _table_name(path))


def _timed_reviews(spark, sf_dir, path, last_first):
    """Reviews with a time, as a stream of files that come in or against their order.

    A last file, a year later, has the watermark pass all others.
    """
    rows = filters.drop_missing_id(reviews(spark, sf_dir)).select("review_id", "company", "ord")
    timed = rows.withColumn("seen", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("ord") % 1000))
    for part in sorted(range(3), reverse=last_first):
        timed.where(F.col("ord") % 3 == part).repartition(1).write.parquet(f"{path}/{2 - part if last_first else part}")
    end = timed.limit(1).withColumn("review_id", F.lit("end")).withColumn("seen", F.col("seen") + F.expr("interval 1 year"))
    end.coalesce(1).write.parquet(f"{path}/3")
    return (
        spark.readStream.schema(timed.schema)
        .options(recursiveFileLookup=True, maxFilesPerTrigger=1)
        .parquet(path)
    )


def stream_first_wins(spark, sf_dir):
    """The first review of each id, out of two streams of the same files in opposite orders."""
    parts = []
    for last_first in (False, True):
        path = scratch_dir(spark)
        source = _timed_reviews(spark, sf_dir, path, last_first)
        first = streams.stream_first(source, ["company", "ord"], "seen", timedelta(days=1), "1 day")
        name = _table_name(path)
        streams.stream_load(first, name, f"{path}-progress", f"{path}-rows").awaitTermination()
        parts.append(read.read_table(spark, name).select("review_id", "company", "ord", F.lit(last_first).alias("reversed")))
    return parts[0].unionByName(parts[1])


def stream_replayed(spark, sf_dir):
    """Files as batches, every batch run twice, as after a failure."""
    path = scratch_dir(spark)
    name = _table_name(path)

    def twice(batch, number):
        for _ in range(2):
            write.load_once(batch, name, f"replayed-{number}", path=f"{path}-rows")

    source = _timed_reviews(spark, sf_dir, path, False)
    query = source.writeStream.option("checkpointLocation", f"{path}-progress").trigger(availableNow=True)
    query.foreachBatch(twice).start().awaitTermination()
    return read.read_table(spark, name).where("review_id <> 'end'").select("review_id", "company", "ord")


def stream_reloaded(spark, sf_dir):
    """Two streams into one table, each of which replaces what it has: the second's rows."""
    path = scratch_dir(spark)
    name = _table_name(path)
    for kind in (0, 1):
        source = _review_stream(spark, sf_dir).where(f"company like '%{kind}'")
        query = streams.stream_load(source, name, f"{path}-progress{kind}", f"{path}-rows", mode="replace")
        query.awaitTermination()
    return read.read_table(spark, name).select("review_id", "company")


def table_staged(spark, sf_dir):
    """A load that fails half way, to a table of the same and of other columns, leaves its rows."""
    path = scratch_dir(spark)
    name = _table_name(path)
    rows = reviews(spark, sf_dir).select("ord", "company", "rating")
    write.load_table(rows.where("ord % 2 = 0"), name, path)
    failing = rows.withColumn("rating", F.expr("if(ord % 100 = 99, raise_error('lost'), rating)"))
    for frame in (failing, failing.withColumn("more", F.lit("x"))):
        try:
            write.load_table(frame, name, path)
        except SparkRuntimeException:
            continue
        raise AssertionError("a load of failing rows went through")
    write.write_table(rows.where("ord % 2 = 1"), name, "append")
    return read.read_table(spark, name)


def stream_reviews(spark, sf_dir):
    """Review files of two layouts as a stream, loaded into a table."""
    path = _review_files(spark, sf_dir)
    rows = streams.stream_reviews(spark, path)
    rows = rows.withColumn("company", F.regexp_extract("company", "^PART-", 0))
    streams.stream_load(rows, _table_name(path), f"{path}-progress", f"{path}-rows").awaitTermination()
    return read.read_table(spark, _table_name(path))


# Files of odd reviews lack three columns and have the others in another order.
_TWO_LAYOUTS = ", ".join(
    f"case when ord % 2 = 0 then {'rating' if n == 'rating' else f'nullif({n}, {_BLANK})'} end as {n}"
    if n in ("title", "rating", "date_published")
    else f"nullif({n}, {_BLANK}) as {n}"
    for n in _FIELDS
)

QUERIES = {
    "company_csv": (
        company_csv,
        f"select {_null_if_blank(_FIELDS)}, lower(company) as slug, company from ({REVIEWS_SQL}) r",
    ),
    "combined_csv": (
        combined_csv,
        f"select {_null_if_blank(_FIELDS)}, company from ({REVIEWS_SQL}) r",
    ),
    "review_folder": (
        review_folder,
        f"select {_TWO_LAYOUTS}, 'PART-' as company, ord from ({REVIEWS_SQL}) r",
    ),
    "classified_parquet": (
        classified_parquet,
        f"select ord, review_id, sentiment_label, rating, error from ({CLASSIFIED_SQL}) c",
    ),
    "table_replaced": (
        table_replaced,
        f"select ord, company, cast(quality as bigint) as quality, rating, error from ({CLASSIFIED_SQL}) c",
    ),
    "table_emptied": (
        table_emptied,
        f"select ord, company, rating from ({REVIEWS_SQL}) r where ord % 2 = 1",
    ),
    "table_appended": (table_appended, f"select ord, company, rating from ({REVIEWS_SQL}) r"),
    "rows_written": (rows_written, "select count(*) as n_rows, count(*) as n_reported from documents"),
    "warehouse_types": (
        warehouse_types,
        """select event_id, cast(cast(ts as date) as varchar) as day,
          cast(cast(value as decimal(12,2)) as varchar) as value, user_id > 10 as known, user_id,
          concat('["', event_type, '"]') as kinds from events""",
    ),
    "stream_dedup": (
        stream_dedup,
        f"""select distinct review_id from ({REVIEWS_SQL}) r
        where review_id is not null and company <> 'SAMPLE'""",
    ),
    "stream_first_wins": (
        stream_first_wins,
        f"""select review_id, company, ord, reversed from (
          select *, row_number() over (partition by review_id order by company, ord) as rn
          from ({REVIEWS_SQL}) r where review_id is not null) k, (select unnest([false, true]) as reversed) o
        where rn = 1""",
    ),
    "stream_replayed": (
        stream_replayed,
        f"select review_id, company, ord from ({REVIEWS_SQL}) r where review_id is not null",
    ),
    "stream_reloaded": (
        stream_reloaded,
        f"select review_id, company from ({REVIEWS_SQL}) r where company like '%1'",
    ),
    "table_staged": (table_staged, f"select ord, company, rating from ({REVIEWS_SQL}) r"),
    "stream_reviews": (
        stream_reviews,
        f"select {_TWO_LAYOUTS}, 'PART-' as company from ({REVIEWS_SQL}) r where review_id is not null",
    ),
}
