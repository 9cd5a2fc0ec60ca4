"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

A document is a vector of terms: pairs of neighbouring character classes (its form), words
by hash, and how many words equal the word before. Each of the three blocks has the square
roots of its shares, so a block's length does not depend on the text's. A truncated
singular value decomposition of the labelled documents' centred vectors gives the latent
space. Each document's cosines with all labelled vectors are computed exactly, in blocks,
and the ``neighbours`` nearest vote with their labels, weighted by similarity.

* The model learns from about ``rows_per_label`` labelled documents per label, those whose
  hash is below a share, a documented bound. So the labelled vectors that are broadcast are
  ``2 * rows_per_label * dimensions`` numbers, whatever the corpus' size.
* Every document is scored over its whole text, without a shuffle.

Defined results: a null or empty text has the vector of no terms and is scored by its
neighbours as well; without any label all scores are 0.5; if several labels are given for
an id, the lowest counts; labels other than 0 and 1, or without id, teach nothing; an id that
several rows have is learned from one of them; repeated rows are scored alike; an empty
table gives an empty result; other columns than those named are not returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import materialize
from .common import in_fold, table
from .tokens import numbered, slices, starts_of, texts_of

ROWS_PER_LABEL = 1500
DIMENSIONS = 32
NEIGHBOURS = 25
BLOCK = 1024
WORD_TERMS = 1024
WORD_WEIGHT = 0.3
MARKS = b"!#$%&'()*+,-./:;<=>?@[]^_`{|}~\""


def character_classes() -> np.ndarray:
    """A class per byte: white space, line end, upper, lower, digit, other, each mark."""
    of = np.full(256, 5, dtype=np.int64)
    of[[9, 11, 12, 13, 32]] = 0
    of[10] = 1
    of[65:91], of[97:123], of[48:58] = 2, 3, 4
    for i, mark in enumerate(MARKS):
        of[mark] = 6 + i
    return of


CLASS_OF = character_classes()
CLASSES = 6 + len(MARKS)
TERMS = CLASSES * CLASSES + WORD_TERMS + 2


def shares(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def term_vectors(texts: list[bytes]) -> np.ndarray:
    """A row of ``TERMS`` numbers per text."""
    n = len(texts)
    of = np.repeat(np.arange(n), [len(t) for t in texts])
    classes = CLASS_OF[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    same = of[1:] == of[:-1]
    pairs = ((of[:-1] * CLASSES + classes[:-1]) * CLASSES + classes[1:])[same]
    form = np.bincount(pairs, minlength=n * CLASSES * CLASSES).reshape(n, -1)
    ids, ends, words = numbered(texts)
    place = np.fromiter((zlib.crc32(w.lower()) % WORD_TERMS for w in words), dtype=np.int64, count=len(words))
    of = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    vocabulary = np.bincount(of * WORD_TERMS + (place[ids] if len(ids) else ids), minlength=n * WORD_TERMS)
    again = np.zeros(len(ids), dtype=np.int64)
    again[1:] = ids[1:] == ids[:-1]
    first = starts_of(ends)
    again[first[first < ends]] = 0
    repeats = np.bincount(of * 2 + again, minlength=n * 2).reshape(n, 2)
    blocks = [shares(form), shares(vocabulary.reshape(n, -1)) * WORD_WEIGHT, shares(repeats)]
    return np.hstack(blocks).astype(np.float32)


@dataclass
class Neighbours:
    """The latent space and the labelled documents in it."""

    mean: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @staticmethod
    def learn(terms: np.ndarray, labels: np.ndarray, dimensions: int) -> Neighbours:
        mean = terms.mean(axis=0) if len(terms) else np.zeros(TERMS, np.float32)
        centred = terms - mean
        k = max(1, min(dimensions, *centred.shape))
        # Subspace iteration from a fixed start.
        space = np.random.default_rng(0).standard_normal((centred.shape[1], k + 8)).astype(np.float32)
        for _ in range(6):
            space, _ = np.linalg.qr(centred.T @ (centred @ space)) if len(terms) else (space, None)
        if len(terms):
            _, _, turn = np.linalg.svd(centred @ space, full_matrices=False)
            space = space @ turn[:k].T
        found = Neighbours(mean, space[:, :k].astype(np.float32), np.empty((0, k), np.float32), labels)
        found.vectors = found.latent(terms)
        return found

    def latent(self, terms: np.ndarray) -> np.ndarray:
        out = (terms - self.mean) @ self.space
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def scores(self, terms: np.ndarray, neighbours: int) -> np.ndarray:
        """Weighted share of label 1 among the nearest, per row."""
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        cosines = self.latent(terms) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, nearest, axis=1).astype(np.float64), 0) ** 2 + 1e-9
        return np.clip((weight * self.labels[nearest]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows_per_label: int) -> DataFrame:
    """``doc_id, text, quality`` of about ``rows_per_label`` documents of each label, by hash."""
    given = materialize(
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    shares = given.groupBy("quality").agg((rows_per_label / F.count(F.lit(1))).alias("_share"))
    # A hash is a number between -2**63 and 2**63, evenly spread.
    low = (F.xxhash64("doc_id") / 2.0**64 + 0.5) < F.col("_share")
    chosen = materialize(given.join(F.broadcast(shares), "quality").where(low).select("doc_id", "quality"))
    # Bounded: about rows_per_label ids per label.
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min_by(F.col("text"), F.xxhash64(F.coalesce("text", F.lit("")))).alias("text"))
    )


def learn(
    docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL, dimensions: int = DIMENSIONS
) -> Neighbours:
    """The labelled vectors of ``docs`` that ``labels`` (``doc_id, quality``) marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in slices(texts):
                rows = [x.tobytes() for x in term_vectors(texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], batch.column("quality")[a:b], pa.array(rows, pa.binary())],
                    ["doc_id", "quality", "terms"],
                )

    sample = labelled_sample(docs, labels, rows_per_label)
    rows = (
        sample.select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(run, "doc_id long, quality int, terms binary")
        .toPandas()
        .sort_values("doc_id")
    )
    terms = np.frombuffer(b"".join(rows["terms"]), dtype=np.float32).reshape(len(rows), TERMS)
    return Neighbours.learn(terms, rows["quality"].to_numpy(dtype=np.float64), dimensions)


def score(docs: DataFrame, model: Neighbours, keep: Sequence[str], neighbours: int = NEIGHBOURS) -> DataFrame:
    """``keep`` and ``score`` of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("_text"))
            out = np.zeros(len(texts))
            for a, b in slices(texts):
                for i in range(a, b, BLOCK):
                    j = min(i + BLOCK, b)
                    out[i:j] = shared.value.scores(term_vectors(texts[i:j]), neighbours)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(out)], [*keep, "score"]
            )

    given = docs.select(*keep, F.col("text").cast("binary").alias("_text"))
    return given.mapInArrow(run, docs.select(*keep).schema.add("score", "double"))


def op4_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = learn(docs.where(~held_out), labels.where(~held_out))
    rows = docs.withColumn("held_out", held_out)
    return score(rows, model, ["doc_id", "held_out"]).withColumn(
        "predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0)
    )


QUERIES = {"op4_neighbour_votes": (op4_neighbour_votes, None)}
