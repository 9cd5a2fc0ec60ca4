"""Training data from raw documents, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents`` (``doc_id, text, lang, source, n_chars``); other columns are carried along, as one value
through each stage, so that their names clash with nothing inside of it.

Defined results: documents with a null text, or one without a letter, go in the first
stage; a document that loses all its lines stays, with an empty text, until the mix, which
takes words and so takes none of it; repeated rows are near-duplicates of each other; an
empty table passes through all stages as an empty table; other nulls change nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake.llm import bpe, language, line_dedup, mixing, near_dups
from reviewlake.llm.common import ship, table, with_only
from reviewlake.scratch import materialize

RANKS = "byte_bpe_50k.tiktoken"

#: Language models and token ids cannot be told in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


#: The columns that stages look at, and the one that has all others.
OWN, CARRIED = ("doc_id", "text", "lang", "source", "n_chars"), "columns carried along"


def carrying(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with columns that are not its own packed before and unpacked after."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c.lower() not in OWN]
        if not others:
            return stage(spark, docs, sf_dir)
        own = [F.col(f"`{c}`") for c in docs.columns if c not in others]
        carried = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias(CARRIED)
        out = stage(spark, docs.select(*own, carried), sf_dir)
        place = {c: F.col(f"`{CARRIED}`")[f"c{i}"].alias(c) for i, c in enumerate(others)}
        return out.select(*[place[c] if c in place else F.col(f"`{c}`") for c in docs.columns])

    return run


def like(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``docs``, ``n_chars`` counted anew."""
    counted = with_only(rows, n_chars=F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint"))
    return counted.select(*docs.columns) if "n_chars" in docs.columns else rows.select(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language, ``lang`` being the one found."""
    ship(spark)
    # The outcome may not be named as a column of the documents.
    found = language.identify(docs, language.learn(docs)).where(F.col("lang_pred") != language.UNDETERMINED)
    return with_only(found, lang=F.col("lang_pred")).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them have."""
    return like(docs, line_dedup.drop_frequent_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return near_dups.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order, a row for each time that one is taken."""
    return like(docs, mixing.training_order(mixing.mix(docs)))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and digests of them and of what they decode to."""
    ship(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.digests(rows, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids_too=True)


STAGES = [
    ("language", carrying(identify_language)),
    ("line_dedup", carrying(drop_shared_lines)),
    ("near_dedup", carrying(drop_near_duplicates)),
    ("source_mix", carrying(mix_sources)),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
