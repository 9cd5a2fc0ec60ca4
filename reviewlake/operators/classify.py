"""Labels of reviews: taxonomy, labeling, validation."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text
from ..functions.answers import parse_answer, read_answer
from ..schema import LABEL_COLS
from ..scratch import materialize
from .filters import drop_blank_text
from .project import enrich
from .report import NEGATIVE, POSITIVE

# The allowed labels.
GENERAL = [
    "Entrega",
    "Recogida y logística inversa",
    "Seguimiento y comunicación",
    "Servicio al cliente",
    "Compensación y reembolso",
    "Calidad del producto entregado",
    "Repartidor",
    "Experiencia general",
    "Valor percibido",
    "Fidelización",
    "Responsabilidad y recuperación",
]
SPECIFIC_NEGATIVE = [
    "Falta de entrega",
    "Retraso en la entrega",
    "Entrega en dirección incorrecta",
    "Entrega sin aviso o contacto",
    "Entrega dañada",
    "Entrega fuera de horario o zona",
    "No se presentó a recoger",
    "Retraso en recogida",
    "Problemas con punto de recogida",
    "Seguimiento incorrecto o sin actualizar",
    "Comunicación inexistente o deficiente",
    "Información confusa o contradictoria",
    "Falta de respuesta a reclamaciones",
    "Atención poco profesional o grosera",
    "Derivación o evasión de responsabilidad",
    "No reembolsan producto o envío",
    "Procesos de reclamo ineficaces",
    "Daño físico al producto",
    "Contenido incompleto o perdido",
    "Repartidor poco profesional",
    "Proceso ineficiente o burocrático",
    "Costo excesivo frente a servicio",
    "Empresa no confiable",
    "Otros",
]
SPECIFIC_POSITIVE = [
    "Entrega puntual",
    "Entrega rápida",
    "Entrega correcta",
    "Entrega en buenas condiciones",
    "Entrega flexible o conveniente",
    "Buen seguimiento",
    "Comunicación efectiva",
    "Aviso previo o confirmación",
    "Atención rápida y resolutiva",
    "Atención amable o profesional",
    "Buena gestión de reclamaciones",
    "Repartidor amable o educado",
    "Repartidor puntual o responsable",
    "Repartidor proactivo",
    "Servicio confiable",
    "Satisfacción general",
    "Profesionalismo",
    "Rapidez de respuesta",
    "Buena relación calidad-precio",
    "Expectativas superadas",
    "Recomendación a otros",
    "Repetición de compra o uso",
    "Resolución satisfactoria de errores",
    "Compromiso con el cliente",
    "Otros",
]
OTHER = "Otros"

# Tries per review, seconds before the second try (then doubled),
# longest pause.
TRIES = 4
FIRST_PAUSE = 2.0
LONGEST_PAUSE = 30.0
FAILED = "Fallo clasificando reseña tras reintentos: "

Labeler = Callable[[pd.Series], Sequence[str]]

LABELED_SCHEMA = "_key binary, " + ", ".join(f"{c} string" for c in [*LABEL_COLS, "error"])


def taxonomy(spark: SparkSession) -> DataFrame:
    """The allowed labels: ``level, polarity, label``."""
    rows = [("general", None, label) for label in GENERAL]
    rows += [("specific", NEGATIVE, label) for label in SPECIFIC_NEGATIVE]
    rows += [("specific", POSITIVE, label) for label in SPECIFIC_POSITIVE]
    level, polarity, label = map(list, zip(*rows))
    return spark.createDataFrame(
        pa.table({"level": level, "polarity": polarity, "label": label})
    )


def _allowed(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    # 60 fixed rows, so both sides are broadcast.
    labels = taxonomy(spark)
    general = labels.where("level = 'general'").select(F.col("label").alias("general_category"))
    specific = labels.where("level = 'specific'").select(
        F.col("polarity").alias("sentiment_label"), F.col("label").alias("specific_category")
    )
    return F.broadcast(general), F.broadcast(specific)


def validate_labels(df: DataFrame) -> DataFrame:
    """Adds ``general_ok`` and ``specific_ok``: label allowed, and fit for the sentiment."""
    general, specific = _allowed(df.sparkSession)
    checked = df.join(
        general.withColumn("general_ok", F.lit(True)), "general_category", "left"
    ).join(
        specific.withColumn("specific_ok", F.lit(True)),
        ["sentiment_label", "specific_category"],
        "left",
    )
    return checked.select(
        *df.columns,
        F.coalesce("general_ok", F.lit(False)).alias("general_ok"),
        F.coalesce("specific_ok", F.lit(False)).alias("specific_ok"),
    )


def nonconforming(df: DataFrame) -> DataFrame:
    """Rows whose labels are not in the taxonomy, or do not fit together."""
    general, specific = _allowed(df.sparkSession)
    conforming = specific.withColumn("_specific", F.lit(1))
    return (
        df.join(conforming, ["sentiment_label", "specific_category"], "left")
        .join(general.withColumn("_general", F.lit(1)), "general_category", "left")
        .where(F.col("_specific").isNull() | F.col("_general").isNull())
        .select(*df.columns)
    )


def default_otros(df: DataFrame) -> DataFrame:
    """Labeled rows without a specific category get the catch-all one."""
    filled = F.coalesce("specific_category", F.when(F.col("sentiment_label").isNotNull(), OTHER))
    return df.withColumn("specific_category", filled)


def parse_answers(df: DataFrame, col: str = "answer") -> DataFrame:
    """Replaces the answer column by the three labels and ``error``; no row is lost."""
    parsed = df.withColumn("_answer", parse_answer(F.col(col)))
    kept = [c for c in df.columns if c != col]
    return parsed.select(*kept, "_answer.*")


def retry(
    labeler: Labeler,
    tries: int = TRIES,
    first_pause: float = FIRST_PAUSE,
    longest_pause: float = LONGEST_PAUSE,
) -> Callable[[pd.Series], pd.DataFrame]:
    """A labeler that asks again for what failed, and at last says why it failed.

    Only the reviews of the batch without a sound answer are asked again, after
    a pause that doubles; there is a pause after the last try, too.
    """

    def label(texts: pd.Series) -> pd.DataFrame:
        results: dict = {}
        pending = texts
        pause = first_pause
        for _ in range(tries):
            try:
                read = [read_answer(a) for a in labeler(pending)]
                if len(read) != len(pending):
                    raise ValueError(f"{len(read)} answers to {len(pending)} reviews")
            except Exception as ex:  # whatever a service client may raise
                read = [{"error": str(ex)}] * len(pending)
            results.update(zip(pending.index, read))
            pending = pending[[results[i].get("error") is not None for i in pending.index]]
            if pending.empty:
                break
            time.sleep(pause)
            pause = min(pause * 2, longest_pause)
        for i in pending.index:
            results[i] = {"error": FAILED + results[i]["error"]}
        columns = [*LABEL_COLS, "error"]
        rows = [[results[i].get(c) for c in columns] for i in texts.index]
        # As objects, since a column without any text would turn into numbers.
        return pd.DataFrame(rows, index=texts.index, columns=columns, dtype=object)

    return label


def answered(spark: SparkSession, path: str) -> DataFrame:
    """The answers written below ``path``, one per text: the sound one, if there are several."""
    try:
        answers = spark.read.schema(LABELED_SCHEMA).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LABELED_SCHEMA)
    values = F.struct(*LABEL_COLS, "error")
    sound_first = F.struct(F.col("error").isNotNull(), *LABEL_COLS, "error")
    one = answers.groupBy("_key").agg(F.min_by(values, sound_first).alias("a"))
    return one.select("_key", "a.*")


def classify(
    df: DataFrame,
    labeler: Labeler,
    text_col: str = "body",
    partitions: int | None = None,
    tries: int = TRIES,
    first_pause: float = FIRST_PAUSE,
    longest_pause: float = LONGEST_PAUSE,
    answers: str | None = None,
    ask_failed_again: bool = False,
) -> DataFrame:
    """Classified rows of the reviews with text.

    ``labeler`` answers a batch of texts. Equal texts are asked for once; their
    answers are written down, so that nothing later asks again. ``df`` is read
    twice. ``partitions`` says over how many tasks the texts are asked for, by
    default as many as the shuffle by text gives. Adaptive execution splits the
    rows of a hot text where they meet its answer.

    ``answers`` is a folder to which answers are added, each task's as soon as it has
    them all, and which outlives the run. Texts that have an answer there are not asked
    for; so after a run that broke off, or with more reviews, only the others are. Its
    digests of texts and labels are all that is read of it. ``ask_failed_again`` asks for
    those, too, for which there is only an error.
    """
    label = retry(labeler, tries, first_pause, longest_pause)
    spark = df.sparkSession

    def label_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.concat([batch["_key"], label(batch["_text"])], axis=1)

    reviews = drop_blank_text(df, text_col)
    stripped = text.strip(F.col(text_col))
    keyed = reviews.withColumn("_key", F.unhex(F.sha2(stripped, 256)))
    # Grouped by the digest, so that 32 bytes are compared and not texts.
    texts = keyed.groupBy("_key").agg(F.first(stripped).alias("_text"))
    if answers is not None:
        known = answered(spark, answers)
        texts = texts.join(known.where("error is null") if ask_failed_again else known, "_key", "left_anti")
    if partitions is not None:
        texts = texts.repartition(partitions, "_key")
    labeled = texts.mapInPandas(label_batches, LABELED_SCHEMA)
    if answers is None:
        labeled = materialize(labeled)
    else:
        # Version 2 has a task's files in place when the task has ended, not all at the end of the job.
        labeled.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", 2).parquet(answers)
        labeled = answered(spark, answers)
    joined = keyed.join(
        labeled.select("_key", F.struct(*LABEL_COLS, "error").alias("_labels")), "_key"
    )
    return enrich(joined, F.col("_labels"), text_col)


# A stand-in for a labeling service: words that speak for a label.
LEXICON = [
    (POSITIVE, "Entrega", "Entrega puntual", ["puntual", "puntuales", "puntualidad"]),
    (POSITIVE, "Entrega", "Entrega rápida", ["rápido", "rápida", "veloz"]),
    (POSITIVE, "Entrega", "Entrega correcta", ["perfecto", "perfecta", "correcto"]),
    (POSITIVE, "Servicio al cliente", "Atención amable o profesional", ["amable", "amables"]),
    (POSITIVE, "Repartidor", "Repartidor amable o educado", ["educado", "simpático"]),
    (POSITIVE, "Experiencia general", "Satisfacción general", ["excelente", "genial", "contento"]),
    (POSITIVE, "Fidelización", "Recomendación a otros", ["recomiendo", "recomendable"]),
    (NEGATIVE, "Entrega", "Retraso en la entrega", ["retraso", "tarde", "demora"]),
    (NEGATIVE, "Entrega", "Falta de entrega", ["nunca", "perdido", "desaparecido"]),
    (NEGATIVE, "Entrega", "Entrega dañada", ["roto", "rota", "dañado", "golpeado"]),
    (NEGATIVE, "Servicio al cliente", "Falta de respuesta a reclamaciones", ["reclamación", "ignoran"]),
    (NEGATIVE, "Compensación y reembolso", "No reembolsan producto o envío", ["reembolso", "dinero"]),
    (NEGATIVE, "Repartidor", "Repartidor poco profesional", ["maleducado", "grosero"]),
    (NEGATIVE, "Experiencia general", "Empresa no confiable", ["estafa", "pésimo", "horrible", "peor"]),
]


#: A lexicon as a table: an entry's words, its labels, and its place among the entries.
LEXICON_SCHEMA = "word string, rank bigint, " + ", ".join(f"{c} string" for c in LABEL_COLS)
NO_WORD = "Sin información suficiente"


def lexicon_table(spark: SparkSession, lexicon: Sequence[tuple] = LEXICON) -> DataFrame:
    """Entries ``sentiment, general, specific, words`` as a table, a row per word."""
    rows = [(w, i, *labels) for i, (*labels, words) in enumerate(lexicon) for w in words]
    return spark.createDataFrame(rows, LEXICON_SCHEMA)


def words_of(review: Column) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.split(F.lower(review), r"(?U)[^\p{L}\p{N}]+"))


def classify_by_lexicon(df: DataFrame, lexicon: DataFrame, text_col: str = "body") -> DataFrame:
    """Classified rows without a labeling service, by a table of words that speak for labels.

    A review has the labels of the entry most of whose words it has, the first one of
    equals; without any of the words it gets no labels and an error. The distinct words of
    distinct texts meet the table in a join, whatever its size; word pairs are counted
    before they are shuffled by text, and labels, which a rank has one set of, are looked up
    for the best rank alone. ``df`` is read twice.
    """
    reviews = drop_blank_text(df, text_col)
    # Half of the digest: it goes with every word of a text.
    digest = F.unhex(F.substring(F.sha2(text.strip(F.col(text_col)), 256), 1, 32))
    keyed = reviews.withColumn("_key", digest)
    entries = lexicon.select("word", "rank").distinct()
    names = lexicon.groupBy("rank").agg(F.min(F.struct(*LABEL_COLS)).alias("labels"))
    words = (
        keyed.groupBy("_key")
        .agg(F.first(words_of(F.col(text_col))).alias("words"))
        .select("_key", F.explode("words").alias("word"))
    )
    scores = words.join(entries, "word").groupBy("_key", "rank").agg(F.count("*").alias("n"))
    first_rank = scores.groupBy("_key").agg(F.max_by("rank", F.struct("n", -F.col("rank"))).alias("rank"))
    best = first_rank.join(names, "rank").drop("rank")
    labeled = keyed.join(best, "_key", "left").withColumn(
        "_labels",
        F.struct(
            *[F.col("labels")[c].alias(c) for c in LABEL_COLS],
            F.when(F.col("labels").isNull(), F.lit(NO_WORD)).alias("error"),
        ),
    )
    return enrich(labeled, F.col("_labels"), text_col)


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
