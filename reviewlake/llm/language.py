"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``max_order`` bytes with the counts of
the bytes that followed them. A byte costs ``-log2`` of its share in the longest context
that it has followed; each longer context that is known but has not seen it costs an
escape (method C: as many escapes as different followers). Below order 0 a byte costs 8
bits. The counts are frozen before scoring, so the cost of a byte depends on the bytes
before it alone, and the costs of all bytes of a text are looked up at once. The language
with the shortest code wins; the score is its probability if all are equally likely.

* The model learns from about ``rows_per_language`` documents per language, those whose hash
  is below a share, a documented bound. Their contexts are counted by Spark; the counts
  are what is collected and broadcast, so their size is bounded by the sample.
* Every document is scored over its whole text, in blocks of ``BLOCK`` bytes, without a
  shuffle.

Defined results: ``und`` with score 0 for a null text, a text without any letter, or if
nothing could be learned; rows with a null ``lang`` or text teach nothing; of languages
with equal code lengths the first by code point; repeated rows are scored alike; an empty
table gives an empty result; input columns named as a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import materialize_counted
from .common import in_fold, table

BLOCK = 1 << 19
#: Languages whose shares are broadcast at most; more are joined by a shuffle.
MAX_LANGUAGES = 10_000
UNDETERMINED = "und"
PAD = b"\n"


def packed(data: np.ndarray, order: int) -> np.ndarray:
    """Each byte from ``order`` on with the ``order`` bytes before it, as one number."""
    n = len(data) - order
    keys = np.zeros(n, dtype=np.uint64)
    for j in range(order + 1):
        keys = (keys << np.uint64(8)) | data[j : j + n].astype(np.uint64)
    return keys


class Lookup:
    """Places of numbers in a sorted array, by an open hash table."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, int(np.ceil(np.log2(len(keys) + 1))) + 1)
        self.shift = np.uint64(64 - bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + np.uint64(1)) & self.mask
        self.stored = np.append(keys, np.uint64(0))

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """-1 where a number is missing."""
        at = self._home(keys)
        found = self.slots[at]
        odd = np.flatnonzero((found >= 0) & (self.stored[found] != keys))
        while len(odd):
            at[odd] = (at[odd] + np.uint64(1)) & self.mask
            found[odd] = self.slots[at[odd]]
            odd = odd[(found[odd] >= 0) & (self.stored[found[odd]] != keys[odd])]
        return found


class ContextTrees:
    """Code lengths per language. ``counts`` has ``lang, order, key, n``."""

    def __init__(self, counts, max_order: int):
        self.languages = sorted(set(counts["lang"]), key=lambda x: x.encode("utf-8", "surrogatepass"))
        self.max_order = max_order
        place = {lang: i for i, lang in enumerate(self.languages)}
        self.found, self.bits, self.contexts, self.escapes = [], [], [], []
        for order in range(max_order + 1):
            rows = counts[counts["order"] == order]
            keys, at = np.unique(rows["key"].to_numpy().astype(np.uint64), return_inverse=True)
            n = np.zeros((len(keys), len(self.languages)))
            np.add.at(n, (at, rows["lang"].map(place).to_numpy(dtype=np.int64)), rows["n"].to_numpy())
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), len(self.languages)))
            np.add.at(total, of, n)
            np.add.at(kinds, of, n > 0)
            whole = np.maximum(total + kinds, 1)
            escapes = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / whole), 0)
            self.contexts.append(contexts)
            self.escapes.append(np.vstack([escapes, np.zeros((1, len(self.languages)))]).astype(np.float32))
            shorter = self.cost(keys & self._mask(order - 1), order - 1)
            seen = -np.log2(np.maximum(n, 1) / whole[of])
            self.found.append(Lookup(keys))
            self.bits.append(np.where(n > 0, seen, escapes[of] + shorter).astype(np.float32))

    @staticmethod
    def _mask(order: int) -> np.uint64:
        return np.uint64((1 << (8 * (order + 1))) - 1)

    def cost(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Bits per language of the last byte of each key, after ``order`` bytes."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), 8, dtype=np.float32)
        at = self.found[order].find(keys)
        out = self.bits[order][at]
        if len(new := np.flatnonzero(at < 0)):
            contexts, missed = self.contexts[order], keys[new] >> np.uint64(8)
            place = np.minimum(np.searchsorted(contexts, missed), len(contexts) - 1)
            place[contexts[place] != missed] = len(contexts)
            out[new] = self.escapes[order][place] + self.cost(keys[new] & self._mask(order - 1), order - 1)
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text per language."""
        out = np.zeros((len(texts), len(self.languages)))
        some, held = [], 0
        for i, text in enumerate(texts):
            some.append(i)
            held += len(text)
            if held >= BLOCK or i == len(texts) - 1:
                self._add(out, some, [texts[j] for j in some])
                some, held = [], 0
        return out

    def _add(self, out: np.ndarray, rows: list[int], texts: list[bytes]) -> None:
        pad = PAD * self.max_order
        data = np.frombuffer(b"".join([pad + t for t in texts]), dtype=np.uint8)
        lengths = np.array([len(t) for t in texts]) + self.max_order
        ends = np.cumsum(lengths)
        for start in range(0, len(data), BLOCK):
            # The first bytes of the next text stand after the last of this one: not scored.
            end = min(start + BLOCK, len(data))
            first = max(start, self.max_order)
            if end <= first:
                continue
            cost = self.cost(packed(data[first - self.max_order : end], self.max_order), self.max_order)
            at = np.arange(first, end)
            of = np.searchsorted(ends, at, side="right")
            real = at - (ends - lengths)[of] >= self.max_order
            cost, of = cost[real], of[real]
            if len(of):
                begins = np.flatnonzero(np.diff(of, prepend=-1))
                np.add.at(out, np.array(rows)[of[begins]], np.add.reduceat(cost, begins, axis=0, dtype=np.float64))


def sample(docs: DataFrame, rows_per_language: int) -> DataFrame:
    """``lang, text`` of about ``rows_per_language`` documents of each language, by hash."""
    labelled = docs.where("lang is not null and text is not null").select(
        "lang", F.xxhash64(F.col("doc_id"), F.col("text")).alias("_h"), "text"
    )
    shares, n = materialize_counted(
        labelled.groupBy("lang").agg((rows_per_language / F.count(F.lit(1))).alias("_share"))
    )
    # A hash is a number between -2**63 and 2**63, evenly spread.
    low = (F.col("_h") / 2.0**64 + 0.5) < F.col("_share")
    chosen = labelled.join(F.broadcast(shares) if n <= MAX_LANGUAGES else shares, "lang").where(low)
    return chosen.dropDuplicates(["lang", "_h"]).select("lang", "text")


def learn(docs: DataFrame, rows_per_language: int = 300, max_order: int = 3) -> ContextTrees:
    """The context trees of the languages of ``docs``' column ``lang``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.frombuffer(PAD * max_order, dtype=np.uint8)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                data = np.concatenate([pad, np.frombuffer(text.as_buffer(), dtype=np.uint8)])
                for order in range(max_order + 1):
                    keys, n = np.unique(packed(data[max_order - order :], order), return_counts=True)
                    size = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * size, pa.string()),
                            pa.array(np.full(size, order, np.int32)),
                            pa.array(keys.astype(np.int64)),
                            pa.array(n.astype(np.int64)),
                        ],
                        ["lang", "order", "key", "n"],
                    )

    counts = (
        sample(docs, rows_per_language)
        .mapInArrow(count, "lang string, order int, key long, n long")
        .groupBy("lang", "order", "key")
        .agg(F.sum("n").alias("n"))
    )
    return ContextTrees(counts.toPandas(), max_order)


def identify(docs: DataFrame, model: ContextTrees, keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all if None) of ``docs``, with ``lang_pred`` and ``score``."""
    names = ("lang_pred", "score")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    trees = docs.sparkSession.sparkContext.broadcast(model)
    # The text is sent once, whether it is carried along or not.
    text = "text" if "text" in kept else "_text"
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = trees.value
            rows = [i for i, letter in enumerate(batch.column("_letter").to_pylist()) if letter and t.languages]
            pred, score = [UNDETERMINED] * len(batch), np.zeros(len(batch))
            if rows:
                bits = t.code_lengths(batch.column(text).cast(pa.binary()).take(rows).to_pylist())
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                for i, b, p in zip(rows, best, share, strict=True):
                    pred[i], score[i] = t.languages[b], p
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                [*kept, *names],
            )

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    more = [] if text == "text" else [F.col("text").alias(text)]
    given = docs.select(*[F.col(f"`{c}`") for c in kept], *more, letter.alias("_letter"))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add("lang_pred", "string").add("score", "double")
    return given.mapInArrow(run, schema)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = learn(docs.where(~held_out))
    # A prediction sees the text alone.
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return identify(rows, model, ["doc_id", "held_out"])


QUERIES = {"op9_language": (op9_language, None)}
