"""Substring dedup: words covered by a window of words that occurs anywhere else.

A difference cover modulo 21 is a set of remainders such that for any two places there is
a shift below 21 that takes both to covered places. So of two equal windows of 35 words,
some 15 words (35 - 20) begin at covered places in both. Only 15-word anchors at covered
places, 5 of 21, are hashed and counted. Where an anchor occurs twice, it is extended: all
windows of 35 words around it are hashed in full and counted.

* The first pass sends a number per anchor, counted per slice of text and in each task
  before the shuffle. The anchors that occur twice are turned into a bitmap of at most
  ``BITMAP`` bits (8 MB), which is broadcast; a false bit only makes a window a candidate.
* The second pass sends the candidate windows. Consecutive windows that have their least
  15-word hash in common travel as one row, dealt by that hash, so equal windows meet.
* A window found twice in one slice is decided there, and one row speaks for all: a passage
  that a third of all documents hold sends a row per slice of text, not per document.
* Places go back to the documents by a digest of the text, equal texts once per task; the
  text meets them in one join, which is the only time that it is moved.

Window hashes and digests have 128 bits.

Defined results: a null text has no words; windows are judged on the input; repeated rows
are documents of their own, so a repeated text of 35 words or more loses all words; a text
shorter than the window keeps its words; an empty table gives an empty result; other
columns than those named are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..scratch import materialize_counted
from .common import table
from .tokens import hashed_words, mixed, rolled, slices, starts_of, texts_of, windows

WINDOW = 35
#: Fixed value: a perfect difference set. Each remainder is a difference of two of them.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
BITMAP = 1 << 26
SLICE = 8_000_000
SEEDS = (11, 12, 13)


class Words:
    """The words of a slice of texts, and where a window or an anchor can begin."""

    def __init__(self, texts: list[bytes], window: int):
        self.hashes, self.ends = hashed_words(texts, xxhash.xxh3_64_intdigest)
        self.window, self.anchor = window, window - PERIOD + 1
        self.begins = starts_of(self.ends)
        fits = windows(self.ends, self.anchor)
        of = np.searchsorted(self.ends, fits, side="right")
        long_enough = (self.ends - self.begins)[of] >= window
        self.fits, self.of = fits[long_enough], of[long_enough]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors at covered places of their texts."""
        covered = np.isin((self.fits - self.begins[self.of]) % PERIOD, COVER)
        at = self.fits[covered]
        return at, rolled(self.hashes, at, self.anchor, SEEDS[0])

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Places at which the windows that hold one of the anchors begin."""
        mark = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        of = np.searchsorted(self.ends, anchors, side="right")
        np.add.at(mark, np.maximum(anchors - PERIOD + 1, self.begins[of]), 1)
        np.add.at(mark, anchors + 1, -1)
        at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        last = (self.ends - self.window)[np.searchsorted(self.ends, at, side="right")]
        return at[at <= last]

    def least(self, at: np.ndarray) -> np.ndarray:
        """The least of the anchor hashes, at any place, within the window at each place."""
        every = np.full(len(self.hashes), np.iinfo(np.uint64).max, dtype=np.uint64)
        every[self.fits] = rolled(self.hashes, self.fits, self.anchor, SEEDS[0])
        width, low = 1, every
        while width * 2 <= PERIOD:
            low = np.minimum(low, np.append(low[width:], np.full(width, low.max(), np.uint64))[: len(low)])
            width *= 2
        return np.minimum(low[at], low[at + PERIOD - width])


def shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """Hashes ``h`` of the anchors that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in slices(texts, SLICE):
                found, n = np.unique(Words(texts[a:b], window).anchors()[1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"]
                )

    return (
        docs.select(F.col("text").cast("binary").alias("text"))
        .mapInArrow(run, "h long, n long")
        .groupBy("h")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select("h")
    )


def bitmap(hashes: DataFrame, n: int) -> np.ndarray:
    """A bit per hash ``h``, by its first bits. Between 2**16 and ``BITMAP`` bits."""
    bits = min(BITMAP.bit_length() - 1, max(16, (16 * n).bit_length()))
    place = F.shiftrightunsigned("h", 64 - bits)
    rows = hashes.withColumn("place", place).select(
        F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
    )
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - (len(bits).bit_length() - 1 + 6))
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run; ``breaks`` marks where a new one begins."""
    begin = np.flatnonzero(breaks)
    return begin, np.append(begin[1:], len(breaks))


#: m: where it is dealt to; key: the text's digest; p, a, b, n: windows, their place, hash and how
#: often the slice has them; sure: first place and number of windows known to be repeated.
ROWS = "m long, key binary, p array<int>, a array<long>, b array<long>, n array<int>, sure array<int>"


def lists(values: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An array per run of adjoining values."""
    offsets = np.append(begin, end[-1:] if len(end) else [0]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def candidate_rows(texts: list[bytes], window: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = Words(texts, window)
    anchors, hashes = words.anchors()
    at = words.around(anchors[in_bitmap(bits, hashes)])
    if not len(at):
        return
    names = [c.split()[0] for c in ROWS.split(", ")]
    a, b = (rolled(words.hashes, at, window, seed) for seed in SEEDS[1:])
    of = np.searchsorted(words.ends, at, side="right")
    digests = {i: hashlib.md5(texts[i]).digest() for i in np.unique(of).tolist()}
    p = (at - words.begins[of]).astype(np.int32)

    # Windows that the slice has several times: the first speaks for all, the rest are sure.
    order = np.lexsort((b, a))
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    begin, end = runs(fresh)
    n = np.zeros(len(at), dtype=np.int32)
    n[order[begin]] = np.minimum(end - begin, 2)

    sent = np.flatnonzero(n > 0)
    least = words.least(at[sent])
    begin, end = runs((np.diff(of[sent], prepend=-1) != 0) | (np.diff(least, prepend=least[0]) != 0))
    first, size = sent[begin], len(begin)
    keys = pa.array([digests[i] for i in of[first].tolist()], pa.binary())
    columns = [pa.array(least[begin].view(np.int64)), keys]
    columns += [
        lists(p[sent], begin, end, pa.int32()),
        lists(a[sent].view(np.int64), begin, end, pa.int64()),
        lists(b[sent].view(np.int64), begin, end, pa.int64()),
        lists(n[sent], begin, end, pa.int32()),
        pa.array([[]] * size, pa.list_(pa.int32())),
    ]
    yield pa.RecordBatch.from_arrays(columns, names)

    sure = np.flatnonzero(n == 0)
    if len(sure):
        begin, end = runs((np.diff(of[sent := sure], prepend=-1) != 0) | (np.diff(at[sure], prepend=-2) != 1))
        first, size = sent[begin], len(begin)
        known = np.column_stack([p[first], end - begin]).astype(np.int32).tolist()
        empty = [[]] * size
        keys = pa.array([digests[i] for i in of[first].tolist()], pa.binary())
        dealt = mixed(words.hashes[at[first]] + p[first].astype(np.uint64)).view(np.int64)
        columns = [pa.array(dealt), keys, pa.array(empty, pa.list_(pa.int32()))]
        columns += [pa.array(empty, pa.list_(pa.int64()))] * 2 + [pa.array(empty, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(known, pa.list_(pa.int32()))], names)


def repeated_windows(docs: DataFrame, window: int, bits: Broadcast) -> DataFrame:
    """``key, starts``: per text, the places at which repeated windows begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in slices(texts, SLICE):
                yield from candidate_rows(texts[a:b], window, bits.value)

    dealt = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, ROWS).repartition("m")
    counted = F.transform(
        F.arrays_zip("p", "a", "b", "n"),
        lambda w: F.struct(w["p"].alias("p"), w["a"].alias("a"), w["b"].alias("b"), w["n"].alias("n")),
    )
    known = F.when(
        F.size("sure") == 2,
        F.transform(
            F.sequence(F.get("sure", F.lit(0)), F.get("sure", F.lit(0)) + F.get("sure", F.lit(1)) - 1),
            lambda p: F.struct(
                p.alias("p"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(2).alias("n")
            ),
        ),
    )
    # What is dealt by m is dealt by m, a and b as well: no other shuffle.
    equal = Window.partitionBy("m", "a", "b")
    return (
        dealt.select("m", "key", F.explode(F.coalesce(known, counted)).alias("w"))
        .select("m", "key", "w.*")
        .withColumn("times", F.sum("n").over(equal))
        .where("times > 1")
        .groupBy("key")
        .agg(F.collect_set("p").alias("starts"))
    )


def kept_words(text: bytes, starts: Sequence[int] | None, window: int) -> tuple[list[bytes], int]:
    """The words that no repeated window covers, and the number of all words."""
    words = text.split()
    if starts is None or not len(starts):
        return words, len(words)
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.asarray(starts, dtype=np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + window, -1)
    free = np.cumsum(mark[:-1]) == 0
    return [words[i] for i in np.flatnonzero(free)], len(words)


def drop_repeated(docs: DataFrame, keep: Sequence[str], window: int = WINDOW, digest: bool = False) -> DataFrame:
    """``keep``, ``n_words, n_removed`` and ``kept`` (the words left; its SHA-256 if ``digest``)."""
    if window < PERIOD + 1:
        raise ValueError(f"a window has more than {PERIOD} words")
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(bitmap(*materialize_counted(shared_anchors(docs, window))))
    starts = repeated_windows(docs, window, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, kept = [], [], []
            places = batch.column("starts")
            for i, text in enumerate(batch.column("_text")):
                at = places[i].values
                words, size = kept_words(text.as_py() or b"", None if at is None else at.to_numpy(), window)
                n.append(size)
                removed.append(size - len(words))
                left = b" ".join(words)
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                [*keep, "n_words", "n_removed", "kept"],
            )

    rows = docs.select(*keep, F.col("text").cast("binary").alias("_text"))
    keyed = rows.withColumn("key", F.unhex(F.md5("_text")))
    schema = docs.select(*keep).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return keyed.join(starts, "key", "left").select(*keep, "_text", "starts").mapInArrow(run, schema)


def op6_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated(docs, ["doc_id"], digest=True).withColumnRenamed("kept", "kept_sha256")


QUERIES = {"op6_difference_cover": (op6_difference_cover, None)}
