"""Labels: reading answers, retrying, validating, classifying."""

import re
import sys
from hashlib import sha256

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from reviewlake.functions import answers
from reviewlake.operators import classify as C

# The labeler below travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FULL = '{"sentiment_label": "Positiva", "general_category": "Entrega", "specific_category": "Otros"}'
LABELS = ("Positiva", "Entrega", "Otros")


def test_coerce_json():
    assert answers.coerce_json('{"sentiment_label": "Positiva"}') == {"sentiment_label": "Positiva"}
    wrapped = 'Aquí está el resultado: {"sentiment_label": "Negativa"}'
    assert answers.coerce_json(wrapped) == {"sentiment_label": "Negativa"}


@pytest.mark.parametrize(
    "answer, error",
    [
        (FULL, None),
        (f"```json\n{FULL}\n```", None),
        (f" {FULL} fin", None),
        (f"{FULL} y {FULL}", "No se pudo parsear"),
        ("{'a': 1}", "No se pudo parsear"),
        ("[1]", "No es un objeto"),
        ("nada", "No se pudo parsear a JSON: nada..."),
        ("", "No se pudo parsear"),
        (None, "No se pudo parsear"),
        ("[" * 100000, "No se pudo parsear"),
        ('{"sentiment_label": "Positiva"}', "Faltan campos obligatorios: ['general_category', 'specific_category']"),
    ],
)
def test_read_answer(answer, error):
    got = answers.read_answer(answer)
    if error is None:
        assert tuple(got[c] for c in C.LABEL_COLS) == LABELS and not got.get("error")
    else:
        assert got["error"].startswith(error)


def test_parse_answer_in_a_table(spark):
    odd = '{"sentiment_label": null, "general_category": 7, "specific_category": "\\udc00"}'
    df = spark.createDataFrame([(0, FULL), (1, "x"), (2, odd), (3, None)], "i int, answer string")
    rows = C.parse_answers(df).orderBy("i").collect()
    assert tuple(rows[0])[1:] == (*LABELS, None)
    assert rows[1].error and rows[1].sentiment_label is None
    assert tuple(rows[2])[1:] == (None, "7", "?", None)
    assert rows[3].error


def test_required_fields(spark):
    df = spark.createDataFrame(
        [(0, FULL), (1, '{"sentiment_label": "Positiva"}'), (2, '{"a": 1}'), (3, "[1]"), (4, FULL.replace('"Otros"', "null")),
         (5, f"{FULL} y {FULL}"), (6, FULL.replace('"', "'")), (7, f"Resultado: {FULL} fin"), (8, None)],
        "i int, j string",
    )
    rows = df.select(
        answers.has_required_fields(F.col("j")).alias("ok"), answers.missing_fields_error(F.col("j")).alias("e")
    ).collect()
    # Two objects, single quotes, a wrapped object, and nothing.
    assert [r.ok for r in rows] == [True, False, False, False, True, False, False, True, False]
    assert [r.e for r in rows[4:]] == [None] * 5
    assert rows[1].e == "Faltan campos obligatorios: ['general_category', 'specific_category']"
    assert rows[0].e is None


def test_taxonomy(spark):
    counts = C.taxonomy(spark).groupBy("level", "polarity").count().collect()
    assert sorted(tuple(map(str, r)) for r in counts) == [
        ("general", "None", "11"),
        ("specific", "Negativa", "24"),
        ("specific", "Positiva", "25"),
    ]


def test_validation(spark):
    df = spark.createDataFrame(
        [
            (0, "Positiva", "Entrega", "Entrega puntual"),
            (1, "Negativa", "Entrega", "Entrega puntual"),
            (2, "Negativa", "entrega", "Otros"),
            (3, None, None, None),
            (4, "Positiva", "Entrega", None),
        ],
        "i int, sentiment_label string, general_category string, specific_category string",
    )
    rows = C.validate_labels(df).orderBy("i").collect()
    assert [(r.general_ok, r.specific_ok) for r in rows] == [
        (True, True), (True, False), (False, True), (False, False), (True, False),
    ]
    assert sorted(r.i for r in C.nonconforming(df).collect()) == [1, 2, 3, 4]
    filled = C.default_otros(df).orderBy("i").collect()
    assert [r.specific_category for r in filled][3:] == [None, "Otros"]


class Flaky:
    """Fails as told, and remembers what it was asked."""

    def __init__(self, failures):
        self.failures, self.asked = failures, []

    def __call__(self, texts):
        self.asked.append(list(texts))
        if self.failures:
            failure = self.failures.pop(0)
            if isinstance(failure, Exception):
                raise failure
            return failure
        return [FULL] * len(texts)


def label(labeler, texts, pauses, **kwargs):
    C.time.sleep, real = pauses.append, C.time.sleep
    try:
        return C.retry(labeler, **kwargs)(pd.Series(texts, index=range(5, 5 + len(texts))))
    finally:
        C.time.sleep = real


def test_retry_asks_again_only_for_what_failed():
    labeler, pauses = Flaky([RuntimeError("x"), ["no", FULL]]), []
    got = label(labeler, ["a", "b"], pauses)
    assert labeler.asked == [["a", "b"], ["a", "b"], ["a"]]
    assert pauses == [2.0, 4.0]
    assert got["error"].isna().all() and list(got["sentiment_label"]) == ["Positiva"] * 2


def test_retry_gives_up_with_a_reason():
    pauses = []
    got = label(Flaky([ValueError("caído")] * 9), ["a"], pauses, tries=6)
    assert pauses == [2.0, 4.0, 8.0, 16.0, 30.0, 30.0]
    assert list(got["error"]) == ["Fallo clasificando reseña tras reintentos: caído"]


def test_retry_notices_lacking_answers():
    got = label(Flaky([[]] * 4), ["a"], [])
    assert "0 answers to 1 reviews" in got["error"].iloc[0]


def shout(texts):
    return [
        "" if t == "mal" else FULL.replace("Positiva", t.upper()) for t in texts
    ]


@pytest.mark.parametrize("partitions", [None, 3])
def test_classify(spark, partitions):
    rows = [(str(i), t, 4.0, "c") for i, t in enumerate([" hola "] * 9 + ["mal", "", None, "adiós", "hola"])]
    df = spark.createDataFrame(rows, "review_id string, body string, rating double, company string")
    got = C.classify(df, shout, partitions=partitions, first_pause=0.0)
    assert got.columns == [
        "review_id", "review", "sentiment_label", "general_category", "specific_category",
        "rating", "company", "error",
    ]
    by_id = {r.review_id: r for r in got.collect()}
    assert set(by_id) == {str(i) for i in (*range(10), 12, 13)}
    assert by_id["0"].review == "hola" and by_id["0"].sentiment_label == "HOLA"
    assert by_id["9"].sentiment_label is None and by_id["9"].error.startswith("Fallo clasificando")
    assert by_id["12"].sentiment_label == "ADIÓS" and by_id["12"].error is None


def test_classify_without_ids(spark):
    df = spark.createDataFrame([("hola", "c")], "body string, company string")
    row = C.classify(df, shout, partitions=3, first_pause=0.0).first()
    assert (row.review_id, row.review) == (None, "hola")
    row = C.classify(df.select("body"), shout, first_pause=0.0).first()
    assert (row.review_id, row.sentiment_label) == (None, "HOLA")


def test_half_of_all_reviews_say_the_same(spark):
    rows = [(str(i), "ok" if i % 2 else f"texto {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "review_id string, body string")
    got = C.classify(df, shout, first_pause=0.0).collect()
    assert sorted((r.review_id, r.review) for r in got) == sorted(rows)
    assert all(r.sentiment_label == r.review.upper() for r in got)


class Logged:
    """Notes down what it is asked for; breaks down at some texts until told not to."""

    def __init__(self, folder, breaks):
        self.folder, self.breaks = str(folder), breaks

    def __call__(self, texts):
        import os
        import time
        import uuid

        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as file:
            file.write("\n".join(texts))
        time.sleep(0.05)
        if self.breaks and any(t.endswith("77") for t in texts):
            raise SystemExit
        return shout(texts)

    def asked(self):
        import os

        return [t for f in os.listdir(self.folder) for t in open(os.path.join(self.folder, f)).read().split("\n")]


def test_answers_outlive_a_run_that_breaks_off(spark, tmp_path):
    rows = [(str(i), f"texto {i % 1000}") for i in range(1500)]
    df = spark.createDataFrame(rows, "review_id string, body string")
    path = str(tmp_path / "answers")
    (tmp_path / "first").mkdir()
    (tmp_path / "second").mkdir()
    first, second = Logged(tmp_path / "first", True), Logged(tmp_path / "second", False)
    with pytest.raises(Exception):
        C.classify(df, first, partitions=200, first_pause=0.0, answers=path)
    kept = {r._key for r in C.answered(spark, path).collect()}
    assert 0 < len(kept) < 1000
    got = C.classify(df, second, partitions=20, first_pause=0.0, answers=path).collect()
    assert sorted((r.review_id, r.review) for r in got) == sorted(rows)
    assert all(r.sentiment_label == r.review.upper() for r in got)
    # What had an answer is not asked for again, all else is, once.
    asked = second.asked()
    assert len(asked) == len(set(asked)) == 1000 - len(kept)
    assert not {sha256(t.encode()).digest() for t in asked} & {bytes(k) for k in kept}
    third = Logged(tmp_path / "second", False)
    assert C.classify(df, third, first_pause=0.0, answers=path).count() == 1500
    assert len(third.asked()) == len(asked)


def test_failed_answers_are_asked_for_on_demand(spark, tmp_path):
    df = spark.createDataFrame([("1", "mal"), ("2", "bien")], "review_id string, body string")
    path = str(tmp_path / "answers")

    def failed(**more):
        rows = C.classify(df, more.pop("labeler", shout), first_pause=0.0, answers=path, **more).collect()
        return {r.review_id for r in rows if r.error}

    mended = lambda texts: [FULL] * len(texts)
    assert failed() == {"1"} and failed(labeler=mended) == {"1"}
    assert failed(labeler=mended, ask_failed_again=True) == set() == failed()


def test_lexicon(spark):
    df = spark.createDataFrame(
        [("1", "Llegó con RETRASO, y encima tarde"), ("2", "Muy puntual"), ("3", "nada"), ("4", "tarde y puntual"),
         ("5", "tarde tarde tarde puntual"), ("6", " "), ("7", None), ("8", "nada")],
        "review_id string, body string",
    )
    rows = {r.review_id: r for r in C.classify_by_lexicon(df, C.lexicon_table(spark)).collect()}
    assert set(rows) == {"1", "2", "3", "4", "5", "8"}
    assert rows["1"].specific_category == "Retraso en la entrega"
    assert rows["2"].sentiment_label == "Positiva"
    assert rows["3"].sentiment_label is None and rows["3"].error and rows["8"].error
    assert rows["4"].specific_category == rows["5"].specific_category == "Entrega puntual"
    none = C.classify_by_lexicon(df, C.lexicon_table(spark).limit(0)).collect()
    assert len(none) == 6 and all(r.error == C.NO_WORD for r in none)


def test_lexicon_is_in_the_taxonomy(spark):
    df = spark.createDataFrame(
        [e[:3] for e in C.LEXICON], "sentiment_label string, general_category string, specific_category string"
    )
    assert C.nonconforming(df).count() == 0


def test_labels_of_a_lexicon_are_not_shuffled_with_words(spark):
    df = spark.createDataFrame([("1", "uno dos dos"), ("2", "dos uno tres tres"), ("3", "x")], "review_id string, body string")
    rows = [("uno", 0, "A", "a", "b"), ("uno", 0, "A", "a", "b"), ("dos", 1, "B", "c", "d"), ("tres", 1, "B", "c", "d")]
    labeled = C.classify_by_lexicon(df, spark.createDataFrame(rows, C.LEXICON_SCHEMA))
    got = labeled.orderBy("review_id").select("sentiment_label", "specific_category").collect()
    assert [tuple(r) for r in got] == [("A", "b"), ("B", "d"), (None, None)]
    plan = labeled._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate(keys=[_key" in plan and not re.search(r"Aggregate\(keys=\[_key#\d+, rank#\d+L, labels", plan)
