"""Sources."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterable, Iterator, Set

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import (
    DataFrame,
    DataFrameReader,
    SparkSession,
    Window,
    functions as F,
    types as T,
)

from ..functions import text
from ..operators.dedup import union_outer
from ..schema import REVIEW_COLS
from ..scratch import materialize
from .write import LOAD


#: Of a block of a file: whole records, one that it leaves open, the end or a middle part of an earlier one.
_RECORD, _OPEN, _REST = 0, 1, 2
_RECORDS = "file string, block bigint, row bigint, part int, value string"


def _lines(spark: SparkSession, pattern: str) -> DataFrame:
    """The lines of files, in the order they have there, with their block's place in the file."""
    return spark.read.option("lineSep", "\n").text(pattern).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """``file, block, inside, header, whole``, a row per block.

    ``inside``: it begins within quotes, told by the quotes in the blocks before. ``whole``:
    the file's quotes do not pair up, so that it must be read in one go.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    at = F.monotonically_increasing_id()
    blocks = materialize(
        lines.select("*", quotes.alias("quotes"), at.alias("at"))
        .groupBy("file", "block")
        .agg(F.sum("quotes").alias("quotes"), F.min_by("value", "at").alias("header"))
    )
    file = Window.partitionBy("file").orderBy("block")
    before = F.sum("quotes").over(file.rowsBetween(Window.unboundedPreceding, -1))
    every = Window.partitionBy("file")
    header = F.max(F.when(F.col("block") == 0, F.col("header"))).over(every)
    return materialize(
        blocks.select(
            "file",
            "block",
            (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"),
            F.regexp_replace(header, "^\ufeff|\r$", "").alias("header"),
            (F.sum("quotes").over(every) % 2 == 1).alias("whole"),
        )
    )


def _records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """``file, row, value``: the records of files whose quotes pair up, in the files' order.

    A record goes on in the next line after an odd number of quotes. So a task that knows
    which of its blocks begin within quotes, eight bytes for each, cuts its lines into
    records; what a block leaves open, or holds of an earlier block's record, is put
    together after that, a few pieces a block.
    """
    spark = lines.sparkSession
    block_hash = F.xxhash64("file", "block")
    begun = blocks.where("inside").select(block_hash.alias("h")).toArrow()["h"].to_numpy()
    inside = spark.sparkContext.broadcast(frozenset(begun.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "row", "part", "value"]
        for found in cut_records(batches, inside.value):
            columns = list(zip(*found))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    pieces = materialize(lines.select("file", "block", block_hash.alias("h"), "value").mapInArrow(run, _RECORDS))
    parts = pieces.where(F.col("part") != _RECORD)
    in_order = Window.partitionBy("file").orderBy("block", F.desc("part"))
    number = F.sum((F.col("part") == _OPEN).cast("int")).over(in_order)
    texts = F.array_sort(F.collect_list(F.struct("block", "part", "value")))
    joined = parts.withColumn("n", number).groupBy("file", "n").agg(F.min("row").alias("row"), texts.alias("texts"))
    together = F.array_join(F.transform("texts", lambda t: t["value"]), "\n")
    whole = pieces.where(F.col("part") == _RECORD).select("file", "row", "value")
    return whole.unionByName(joined.select("file", "row", together.alias("value")))


def cut_records(
    batches: Iterator[pa.RecordBatch], inside: Set[int]
) -> Iterator[list[tuple[str, int, int, int, str]]]:
    """Lines ``file, block, h, value`` as records and parts of records ``file, block, row, part, value``."""
    key, row, held, begun = None, 0, [], None

    def closed() -> list[tuple]:
        """What the block leaves open."""
        if not held:
            return []
        return [(*key[:2], begun if begun is not None else key[1], _OPEN if begun is not None else _REST, "\n".join(held))]

    for batch in batches:
        values = batch.column("value")
        odd = pc.equal(pc.bit_wise_and(pc.count_substring(values, '"'), 1), 1).to_pylist()
        out = []
        for file, block, h, value, turns in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "h")), values.to_pylist(), odd):
            if (file, block, h) != key:
                out += closed()
                # Not yet ended, and begun elsewhere.
                key, row, held, begun = (file, block, h), block, [], None
                within = h in inside
            if not within and not turns:
                out.append((file, block, row, _RECORD, value))
            elif not within:
                held, begun, within = [value], row, True
            else:
                held.append(value)
                if turns:
                    text = "\n".join(held)
                    out.append((file, block, block, _REST, text) if begun is None else (file, block, begun, _RECORD, text))
                    held, begun, within = [], None, False
            row += 1
        if out:
            yield out
    if out := closed():
        yield out


def _csv(spark: SparkSession, names: Iterable[str], multi_line: bool) -> DataFrameReader:
    """Reader of CSV files with the given columns, all of them text."""
    return spark.read.schema(
        T.StructType([T.StructField(n, T.StringType()) for n in names])
    ).options(header=True, multiLine=multi_line, quote='"', escape='"')


def _not_there(ex: AnalysisException) -> bool:
    return ex.getCondition() == "PATH_NOT_FOUND"


def read_review_folder(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.csv`` files of a folder, with ``company`` from the file name.

    Files may have different columns; they are matched by name. All columns are
    text and an empty value is null. ``row`` gives the order within a file.

    Files are split, those with line breaks inside quotes as well (``_records``), and each
    record is parsed by Spark. Quotes within a value are doubled, as CSV writers do; a file
    with an odd number of quotes is read by one task. Only the distinct layouts come to
    the driver; with several, records meet their file's layout in a join.
    """
    pattern = f"{path.rstrip('/')}/*.csv"
    try:
        lines = _lines(spark, pattern)
        blocks = _blocks(lines)
    except AnalysisException as ex:
        if _not_there(ex):
            raise FileNotFoundError(f"no CSV files in {path}") from ex
        raise
    files = materialize(blocks.select("file", "header", "whole").distinct())
    layouts = sorted(files.select("header", "whole").distinct().collect())
    if not layouts:
        raise FileNotFoundError(f"no CSV files in {path}")
    names = {header: next(csv.reader([header])) for header, _ in layouts}
    every = list(dict.fromkeys(n for header, _ in layouts for n in names[header]))
    places = [f"_c{i}" for i in range(max(map(len, names.values())))]
    schema = ", ".join(f"{c} string" for c in places)
    parts = []
    for whole in sorted({whole for _, whole in layouts}):
        if whole:
            rows = _csv(spark, places, True).csv(pattern).select(
                *places, F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")
            )
        else:
            # The first record is the header; lines of nothing are no records.
            records = _records(lines, blocks).where((F.col("row") > 0) & F.rlike("value", F.lit(r"[^\s]")))
            record = F.regexp_replace("value", "\r$", "")
            parsed = F.from_csv(record, schema, {"quote": '"', "escape": '"'}).alias("r")
            rows = records.select("file", "row", parsed).select("file", "row", "r.*")
        parts.append(rows.join(files.where(F.col("whole") == whole).select("file", "header"), "file"))
    rows = union_outer(parts)
    columns = []
    for n in (n for n in every if n.lower() not in ("company", "row")):
        value = F.lit(None).cast("string")
        for header, listed in names.items():
            if n in listed:
                here = F.col(places[listed.index(n)])
                value = here if len(names) == 1 else F.when(F.col("header") == header, here).otherwise(value)
        columns.append(text.blank_to_null(value).alias(n))
    company = text.company_from_path(F.element_at(F.split("file", "/"), -1)).alias("company")
    return rows.select(*columns, company, "row")


def read_combined(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """What ``write_combined`` wrote; CSV columns are text, an empty value is null.

    Its files have one layout and may have line breaks inside quotes, so each is
    read by one task, as it was written by one.
    """
    try:
        if fmt != "csv":
            return spark.read.format(fmt).load(path)
        rows = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    except AnalysisException as ex:
        if _not_there(ex):
            raise FileNotFoundError(path) from ex
        raise
    return rows.select(*[text.blank_to_null(F.col(f"`{n}`")).alias(n) for n in rows.columns])


def read_company_csv(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_company_csv`` wrote: the review fields, ``slug``, ``company``.

    Filters on ``slug`` read that company's folder only.
    """
    rows = _csv(spark, [*REVIEW_COLS, "slug"], True).csv(path)
    fields = {c: text.blank_to_null(F.col(c)) for c in REVIEW_COLS}
    fields["rating"] = text.rating_float(F.col("rating"))
    return rows.withColumns(fields).withColumn("company", text.company_from_slug(F.col("slug")))


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """The table itself; KeyError if a column is missing."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table, without what says which load they came with."""
    return spark.read.table(name).drop(LOAD)


def read_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A page snapshot ``page_id, url, html``.

    With ``partitions`` it is dealt out anew, for a snapshot of few files, as reading
    HTML costs more than moving it.
    """
    pages = spark.read.parquet(path)
    if partitions is not None:
        pages = pages.repartition(partitions, "url")
    return require_columns(pages, ["page_id", "url", "html"])


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
