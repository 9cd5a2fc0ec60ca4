"""Classification."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from reviewlake.functions import answers as answer_functions
from reviewlake.operators import classify as C
from reviewlake.operators.report import NEGATIVE, POSITIVE
from reviewlake.scratch import scratch_dir

from . import sql
from .inputs import (
    ANSWER_FAILS,
    ANSWER_LABELS,
    ANSWERS_SQL,
    REVIEWS_SQL,
    answers,
    reviews,
    table,
)

_LABELS_SQL = ", ".join(
    f"case when not {ANSWER_FAILS} then {label} end as {name}" for name, label in ANSWER_LABELS.items()
)
_PARSED_SQL = f"select ord, {_LABELS_SQL}, {ANSWER_FAILS} as failed from ({ANSWERS_SQL}) a"

# A lexicon of words the documents have.
LEXICON = [
    (POSITIVE, "Entrega", "Entrega puntual", ["the", "and", "of"]),
    (POSITIVE, "Repartidor", "Repartidor proactivo", ["und", "der", "für"]),
    (NEGATIVE, "Entrega", "Retraso en la entrega", ["les", "une", "pour"]),
    (NEGATIVE, "Servicio al cliente", "Otros", ["los", "una", "para"]),
]


def _parsed(spark, sf_dir):
    return C.parse_answers(answers(spark, sf_dir))


def parse_answers(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    return parsed.select("ord", *ANSWER_LABELS, F.col("error").isNotNull().alias("failed"))


# Turns as they are, turns as a label inside an answer, and turns around an answer.
_TURN = """case conv_id % 3 when 0 then text
  when 1 then concat('{"sentiment_label": "', regexp_replace(text, '[^A-Za-z ]', ''),
    '", "general_category": null, "specific_category": [1]}')
  else concat(regexp_replace(text, '[{}]', ''), '{"specific_category": "c", "general_category": "g", "sentiment_label": "',
    role, '"}') end"""


def parse_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", f"{_TURN} as answer")
    parsed = C.parse_answers(turns)
    return parsed.select(
        "conv_id", "turn", *ANSWER_LABELS, F.col("error").isNotNull().alias("failed")
    )


def label_errors(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    return parsed.groupBy("company").agg(
        F.count(F.lit(1)).alias("n"), F.count("error").alias("n_errors"),
        F.count("sentiment_label").alias("n_labeled"),
    )


def required_fields(spark, sf_dir):
    answer = F.col("answer")
    return answers(spark, sf_dir).select(
        "ord",
        answer_functions.has_required_fields(answer).alias("complete"),
        answer_functions.missing_fields_error(answer).alias("missing"),
    )


def validate_labels(spark, sf_dir):
    return C.validate_labels(_parsed(spark, sf_dir)).select("ord", "general_ok", "specific_ok")


def nonconforming_labels(spark, sf_dir):
    labeled = _parsed(spark, sf_dir).where("error is null")
    return C.nonconforming(labeled).select("ord", "specific_category")


def default_category(spark, sf_dir):
    unknown = F.when(F.col("specific_category") != "Inventada", F.col("specific_category"))
    rows = _parsed(spark, sf_dir).withColumn("specific_category", unknown)
    return C.default_otros(rows).select("ord", "specific_category")


def _first_letter_labeler(texts):
    """Stands in for a service: answers by the text's first letter and length."""
    out = []
    for t in texts:
        if len(t) % 7 == 0:
            out.append("no lo sé")
        else:
            sentiment = "Positiva" if t[0] in "AEIOUaeiou" else "Negativa"
            out.append(
                f'Claro: {{"sentiment_label": "{sentiment}", "general_category": "Entrega",'
                ' "specific_category": "Otros"}'
            )
    return out


def classify_reviews(spark, sf_dir):
    labeled = C.classify(
        reviews(spark, sf_dir, spread=True),
        _first_letter_labeler,
        first_pause=0.0,
    )
    return labeled.select(
        "review_id",
        "review",
        "sentiment_label",
        "general_category",
        "specific_category",
        "company",
        F.col("error").isNotNull().alias("failed"),
    )


def classify_by_lexicon(spark, sf_dir):
    return _by_lexicon(spark, sf_dir, C.lexicon_table(spark, LEXICON))


def _by_lexicon(spark, sf_dir, lexicon):
    labeled = C.classify_by_lexicon(reviews(spark, sf_dir, spread=True), lexicon)
    return labeled.select(
        "review_id", "company", "sentiment_label", "general_category", "specific_category",
        F.col("error").isNotNull().alias("failed"),
    )


# An entry per specific label. Half of all words speak for one, told by their digest.
ENTRIES = [
    (i, sentiment, C.GENERAL[i % len(C.GENERAL)], specific)
    for i, (sentiment, specific) in enumerate(
        [(NEGATIVE, x) for x in C.SPECIFIC_NEGATIVE] + [(POSITIVE, x) for x in C.SPECIFIC_POSITIVE]
    )
]


def large_lexicon(spark, sf_dir):
    """A lexicon of half of the words that the documents have."""
    entries = spark.createDataFrame(ENTRIES, "rank bigint, " + ", ".join(f"{c} string" for c in C.LABEL_COLS))
    words = reviews(spark, sf_dir).select(F.explode(C.words_of(F.col("body"))).alias("word")).where("word <> ''").distinct()
    rank = F.conv(F.substring(F.md5("word"), 1, 4), 16, 10).cast("bigint") % 98
    return words.withColumn("rank", rank).join(F.broadcast(entries), "rank")


def classify_by_large_lexicon(spark, sf_dir):
    return _by_lexicon(spark, sf_dir, large_lexicon(spark, sf_dir))


def classify_resumed(spark, sf_dir):
    """A first run over half of the reviews, then one over all; how often each text was asked for."""
    rows = reviews(spark, sf_dir, spread=True)
    path = scratch_dir(spark)
    C.classify(rows.where("ord % 2 = 0"), _first_letter_labeler, first_pause=0.0, answers=path)
    n_first = spark.read.parquet(path).count()
    labeled = C.classify(rows, _first_letter_labeler, first_pause=0.0, answers=path)
    asked = spark.read.parquet(path).groupBy("_key").agg(F.count("*").alias("asked"))
    return (
        labeled.withColumn("_key", F.unhex(F.sha2("review", 256)))
        .join(asked, "_key")
        .groupBy("sentiment_label", "asked")
        .agg(F.count("*").alias("n"), F.count_distinct("review").alias("texts"))
        .withColumn("first_run", F.lit(n_first))
    )


_WORDS = r"list_distinct(regexp_split_to_array(lower(body), '[^\p{L}\p{N}]+'))"
_SCORES = ", ".join(
    f"len(list_intersect(words, [{', '.join(repr(w) for w in words)}])) as s{i}"
    for i, (*_, words) in enumerate(LEXICON)
)
_BEST = "case greatest(s0, s1, s2, s3) when 0 then null " + " ".join(
    f"when s{i} then {i}" for i in range(len(LEXICON))
) + " end"


def _pick(field: int, name: str) -> str:
    return "case best " + " ".join(
        f"when {i} then '{entry[field]}'" for i, entry in enumerate(LEXICON)
    ) + f" end as {name}"


_REVIEW = sql.strip("body")

QUERIES = {
    "parse_answers": (parse_answers, _PARSED_SQL),
    "parse_conversations": (
        parse_conversations,
        """select conv_id, turn, case conv_id % 3 when 1 then regexp_replace(text, '[^A-Za-z ]', '', 'g')
            when 2 then role end as sentiment_label,
          case conv_id % 3 when 2 then 'g' end as general_category,
          case conv_id % 3 when 1 then '[1]' when 2 then 'c' end as specific_category,
          conv_id % 3 = 0 as failed from conversations""",
    ),
    "label_errors": (
        label_errors,
        f"""select company, count(*) as n, count(*) filter (where {ANSWER_FAILS}) as n_errors,
          count(*) filter (where not {ANSWER_FAILS}) as n_labeled from ({ANSWERS_SQL}) a group by 1""",
    ),
    "required_fields": (
        required_fields,
        f"""select ord, not {ANSWER_FAILS} as complete, case when ord % 19 <> 0 and ord % 17 = 0
          then 'Faltan campos obligatorios: [''specific_category'']' end as missing from ({ANSWERS_SQL}) a""",
    ),
    "validate_labels": (
        validate_labels,
        f"""select ord, not {ANSWER_FAILS} as general_ok,
          not {ANSWER_FAILS} and ord % 23 <> 0 as specific_ok from ({ANSWERS_SQL}) a""",
    ),
    "nonconforming_labels": (
        nonconforming_labels,
        f"""select ord, 'Inventada' as specific_category from ({ANSWERS_SQL}) a
        where not {ANSWER_FAILS} and ord % 23 = 0""",
    ),
    "default_category": (
        default_category,
        f"""select ord, case when failed then null when specific_category = 'Inventada' then 'Otros'
          else specific_category end as specific_category from ({_PARSED_SQL}) p""",
    ),
    "classify_reviews": (
        classify_reviews,
        f"""select review_id, review,
          case when failed then null when substring(review, 1, 1) in
            ('A','E','I','O','U','a','e','i','o','u') then 'Positiva' else 'Negativa' end as sentiment_label,
          case when not failed then 'Entrega' end as general_category,
          case when not failed then 'Otros' end as specific_category, company, failed
        from (select *, {_REVIEW} as review, length({_REVIEW}) % 7 = 0 as failed
              from ({REVIEWS_SQL}) r) s where review <> ''""",
    ),
    "classify_by_lexicon": (
        classify_by_lexicon,
        f"""select review_id, company, {_pick(0, 'sentiment_label')}, {_pick(1, 'general_category')},
          {_pick(2, 'specific_category')}, best is null as failed
        from (select *, {_BEST} as best from (select *, {_SCORES} from (
          select *, {_WORDS} as words from ({REVIEWS_SQL}) r where {_REVIEW} <> '') w) s) b""",
    ),
    "classify_by_large_lexicon": (
        classify_by_large_lexicon,
        f"""with entries as (select * from (values {', '.join(map(str, ENTRIES))})
            t(rank, sentiment_label, general_category, specific_category)),
          said as (select ord, review_id, company, unnest({_WORDS}) as word
            from ({REVIEWS_SQL}) r where {_REVIEW} <> ''),
          scores as (select ord, rank, count(*) as n from (
            select ord, ('0x' || substring(md5(word), 1, 4))::bigint % 98 as rank from said where word <> '')
            join entries using (rank) group by ord, rank),
          best as (select ord, rank from scores qualify row_number() over (partition by ord order by n desc, rank) = 1)
        select review_id, company, sentiment_label, general_category, specific_category, rank is null as failed
        from ({REVIEWS_SQL}) r left join best using (ord) left join entries using (rank)
        where {_REVIEW} <> ''""",
    ),
    "classify_resumed": (
        classify_resumed,
        f"""with texts as (select ord, {_REVIEW} as review from ({REVIEWS_SQL}) r where {_REVIEW} <> '')
        select case when length(review) % 7 = 0 then null when substring(review, 1, 1) in
            ('A','E','I','O','U','a','e','i','o','u') then 'Positiva' else 'Negativa' end as sentiment_label,
          1 as asked, count(*) as n, count(distinct review) as texts,
          (select count(distinct review) from texts where ord % 2 = 0) as first_run
        from texts group by 1""",
    ),
}

# The labeler travels with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
