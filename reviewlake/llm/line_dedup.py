"""Dropping lines that many documents share, in DataFrame functions alone.

Lines are exploded, their normalised form is hashed, the distinct documents of each
hash are counted, lines of hashes at the threshold go, and the rest is put together
again by position.

* A document counts once per hash: its hashes are made distinct before they are
  exploded, and counts are combined in each task before the shuffle, so a line that a
  third of all documents share is one row per task there.
* What tells which lines go depends on the text alone, so the numbers of dropped lines
  are gathered per digest of the text, and equal texts are combined in each task.
* The text itself is moved once, to meet those numbers. Both joins are left to adaptive
  execution, which splits the rows of a hot key and broadcasts a side that it has
  measured to be small.

Hashes are 96 bits of two functions, digests of texts 128 bits.

Defined results: a document is a row, so repeated rows count as documents of their own
and get the same result; a null or empty text is one empty line; a line whose key has
fewer than ``min_chars`` code points stays; a document that loses all its lines stays,
with an empty text; an empty table gives an empty result; input columns named as a
result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..scratch import materialize
from .common import table, with_only

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key(line: Column) -> Column:
    """The line without outer white space, its A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(SPACE)), UPPER, LOWER)


def hashed(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def frequent_lines(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """Hashes ``a, b`` of the keys that at least ``min_docs`` documents have."""
    keys = F.transform(F.split("text", "\n"), key)
    long_enough = F.filter(keys, lambda k: F.char_length(k) >= min_chars)
    return (
        docs.select(F.explode(F.array_distinct(F.transform(long_enough, hashed))).alias("h"))
        .groupBy("h.a", "h.b")
        .count()
        .where(F.col("count") >= min_docs)
        .select("a", "b")
    )


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``text`` without its frequent lines, ``n_lines`` and ``n_dropped``."""
    frequent = materialize(frequent_lines(docs, min_docs, min_chars))
    keyed = F.transform(F.split("text", "\n"), key)
    hashes = F.transform(
        keyed, lambda k: F.when(F.char_length(k) >= min_chars, hashed(k))
    )
    # Written down, so that the texts' side of the last join can be split where a text is hot.
    dropped = materialize(
        docs.select(F.md5("text").alias("_digest"), F.posexplode(hashes).alias("_at", "h"))
        .where("h is not null")
        .select("_digest", "_at", "h.a", "h.b")
        .join(frequent, ["a", "b"], "left_semi")
        .groupBy("_digest")
        .agg(F.collect_set("_at").alias("_dropped"))
    )
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.transform(F.array_except(numbers, F.col("_dropped")), lambda i: F.get(lines, i))
    kept = F.when(F.col("_dropped").isNull(), text).otherwise(F.array_join(left, "\n"))
    joined = docs.withColumn("_digest", F.md5("text")).join(dropped, "_digest", "left")
    return with_only(
        joined,
        text=kept,
        n_lines=F.size(lines).cast("bigint"),
        n_dropped=F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint"),
    ).drop("_digest", "_dropped")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_frequent_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


SQL = r"""
with lines as (
  select d.rowid as row, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from (select row_number() over () as rowid, * from documents) d),
keyed as (
  select row, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
frequent as (
  select key from keyed where length(key) >= 1 group by key having count(distinct row) >= 10),
marked as (select k.*, f.key is not null as dropped from keyed k left join frequent f using (key)),
kept as (
  select row, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
    coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '') as text
  from marked group by row)
select d.doc_id, n_lines, n_dropped, sha256(kept.text) as kept_sha256
from (select row_number() over () as row, doc_id from documents) d join kept using (row)
"""

QUERIES = {"op8_line_dedup": (op8_line_dedup, SQL)}
