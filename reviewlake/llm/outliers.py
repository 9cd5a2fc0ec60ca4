"""Quality rules: robust multivariate outliers per language and source.

A text's statistics are turned into a vector of four (``FEATURES``). For each language
and source the minimum-covariance-determinant estimate of centre and covariance is found:
from medians and quartiles, concentration steps keep the ``HALF`` share of documents with
the smallest distances and estimate anew, which never raises the determinant, until none
falls any more; then the estimate is scaled to the median distance, and documents within
the 97.5 % distance give the final one. A document whose squared Mahalanobis distance
exceeds ``cutoff`` goes.

* The texts are read once and not moved; what follows works on a written table with a few
  numbers per document.
* Every step is an aggregate per group, combined in each task before the shuffle (sums,
  products and quantile sketches), so a group with a third of all documents is no task.
  The estimates are a row per group; documents meet them in a join that adaptive
  execution broadcasts or splits by its measured size.
* Estimates of few documents lean on those of more: one from n documents is mixed with
  that of its language by ``n`` to ``PRIOR``, a language's likewise with that of all documents;
  the spread between the two centres counts. So every language and source has an estimate
  of its own, and no size changes the rule.
* A least deviation per feature (``FLOORS``) is added to each covariance, so features that
  most documents have at one value do not make every other value an outlier.

Documents that fail the base rules take no part in the estimates.

Defined results: a null or empty text has no words and fails the base; a null language or
source is a group of its own; repeated rows are documents of their own; an empty table
gives an empty result; other columns than those named are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..scratch import materialize
from .common import table
from .tokens import mixed, numbered, slices, starts_of, texts_of, windows

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

HALF = 0.75
#: Documents that the estimate of the next larger group counts for.
PRIOR = 50
#: Fixed values of the chi-squared distribution with 4 degrees: median, 97.5 %, 99.999 %.
CHI2_MEDIAN, CHI2_975, CHI2_FAR = 3.3567, 11.1433, 28.4733
#: Least standard deviations of the features.
FLOORS = (0.05, 0.1, 0.1, 0.15)


def features() -> list[Column]:
    n = F.col("n_words")
    return [
        # Short texts are drawn to a length of 5, as their means scatter.
        F.log((F.col("word_chars") + 150) / (n + 30)),
        F.sqrt(F.col("n_symbols") / (n + 10)),
        F.sqrt(F.col("n_dup_lines") / (n + 10)),
        F.sqrt(F.col("n_repeat_words") / (n + 10)),
    ]


D = 4
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def repeated_words(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text, the words in windows that it has twice or more."""
    at = windows(ends, WINDOW)
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    if len(at):
        of = np.searchsorted(ends, at, side="right").astype(np.uint64)
        keys = mixed(of + np.uint64(1))
        for j in range(WINDOW):
            keys = mixed(keys ^ (ids[at + j].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(covered, at[twice], 1)
        np.add.at(covered, at[twice] + WINDOW, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return inside[ends] - inside[starts_of(ends)]


def duplicate_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    n = 0
    for line in lines:
        if line in seen:
            n += bool(line.strip(SPACES))
        else:
            seen.add(line)
    return n


def code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode("utf-8", "replace"))


def statistics(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``STATISTICS`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("_text"))
            out = np.zeros((len(STATISTICS), len(texts)), dtype=np.int64)
            for a, b in slices(texts):
                ids, ends, _ = numbered(texts[a:b])
                out[0, a:b] = np.diff(ends, prepend=0)
                out[4, a:b] = repeated_words(ids, ends)
                for i in range(a, b):
                    t = texts[i]
                    out[1, i] = code_points(t) - sum(t.count(SPACES[k : k + 1]) for k in range(len(SPACES)))
                    out[2, i] = sum(t.count(SYMBOLS[k : k + 1]) for k in range(len(SYMBOLS)))
                    out[3, i] = duplicate_lines(t)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(x) for x in out]], [*keep, *STATISTICS]
            )

    given = docs.select(*keep, F.col("text").cast("binary").alias("_text"))
    schema = docs.select(*keep).schema
    for name in STATISTICS:
        schema = schema.add(name, "long")
    return given.mapInArrow(run, schema)


def white(cov: np.ndarray) -> list[float]:
    """The lower triangle that makes vectors of this covariance white."""
    inverse = np.linalg.inv(np.linalg.cholesky(cov))
    return [inverse[i, j] for i, j in PAIRS]


def estimates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre, whitening matrix and covariance of each group, from its sums and products."""
    floor = np.diag(np.square(FLOORS))
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            mean = np.array([getattr(r, f"s{i}") for i in range(D)]) / r.n
            cov = np.zeros((D, D))
            for i, j in PAIRS:
                cov[i, j] = cov[j, i] = getattr(r, f"s{i}{j}") / r.n - mean[i] * mean[j]
            values, vectors = np.linalg.eigh(cov)
            cov = (vectors * np.maximum(values, 0)) @ vectors.T * r.scale + floor
            rows.append((r.group, *mean, *white(cov), *[cov[i, j] for i, j in PAIRS]))
        yield pd.DataFrame(rows, columns=["group", *CENTRE, *WHITE, *COVARIANCE])


CENTRE = [f"c{i}" for i in range(D)]
WHITE = [f"w{i}{j}" for i, j in PAIRS]
COVARIANCE = [f"v{i}{j}" for i, j in PAIRS]
ESTIMATE = "group string, " + ", ".join(f"{c} double" for c in [*CENTRE, *WHITE, *COVARIANCE])


def distance() -> Column:
    """Squared Mahalanobis distance, from the columns of an estimate."""
    total = F.lit(0.0)
    for i in range(D):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"w{i}{j}") * (F.col(f"x{j}") - F.col(f"c{j}"))
        total = total + y * y
    return total


def fitted(rows: DataFrame, scale: Column) -> DataFrame:
    """The estimates from the rows of each group, the covariance times ``scale``."""
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(D)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS]
    per_group = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), scale.alias("scale"), *sums, *products)
    return materialize(per_group.mapInPandas(estimates, ESTIMATE))


def first_estimates(rows: DataFrame) -> DataFrame:
    """Medians, and deviations from quartiles, of each group."""
    quartiles = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(D)]
    found = rows.groupBy("group").agg(*quartiles)
    spread = [
        F.sqrt(F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + FLOORS[i] ** 2) for i in range(D)
    ]
    return materialize(
        found.select(
            "group",
            *[F.col(f"q{i}")[1].alias(f"c{i}") for i in range(D)],
            *[(1 / spread[i] if i == j else F.lit(0.0)).alias(f"w{i}{j}") for i, j in PAIRS],
        )
    )


def group_keys() -> list[Column]:
    """All documents, those of the language, those of the language and source."""
    return [F.lit("[]"), F.to_json(F.array("lang")), F.to_json(F.array("lang", "source"))]


def log_determinants(estimate: DataFrame) -> float:
    """The sum of the logarithms of all groups' determinants."""
    own = -2 * sum((F.log(f"w{i}{i}") for i in range(D)), F.lit(0.0))
    return estimate.agg(F.sum(own)).first()[0] or 0.0


def concentrated(rows: DataFrame) -> DataFrame:
    """The estimates from the ``HALF`` share of each group that no step makes any smaller."""
    estimate, before, now = first_estimates(rows), float("inf"), float("inf")
    # The first estimate is of no subset, so its determinant says nothing.
    while before == float("inf") or now < before - 1e-6 * max(1.0, abs(before)):
        far = rows.join(estimate, "group").withColumn("d", distance())
        limit = materialize(far.groupBy("group").agg(F.percentile_approx("d", HALF, 1000).alias("limit")))
        found = fitted(far.join(limit, "group").where("d <= limit"), F.lit(1.0))
        before, now = now, log_determinants(found)
        # Quantiles are approximate, so a last step may come out a little larger.
        estimate = found if now <= before else estimate
    return estimate


def drawn(own: DataFrame, parent: DataFrame, prior: float) -> DataFrame:
    """``own`` estimates of ``n`` documents, mixed with those of their ``parent``."""
    numbers = [*CENTRE, *COVARIANCE]
    named = parent.select(F.col("group").alias("parent"), *[F.col(c).alias(f"p_{c}") for c in numbers])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["group", "n", *numbers]].copy()
            for at, row in enumerate(batch[COVARIANCE].to_numpy()):
                cov = np.zeros((D, D))
                for (i, j), v in zip(PAIRS, row):
                    cov[i, j] = cov[j, i] = v
                out.loc[out.index[at], WHITE] = white(cov)
            yield out[["group", "n", *CENTRE, *WHITE, *COVARIANCE]]

    share = F.col("n") / (F.col("n") + prior)
    # Both together: what lies between their centres is spread as well.
    apart = {f"v{i}{j}": (F.col(f"c{i}") - F.col(f"p_c{i}")) * (F.col(f"c{j}") - F.col(f"p_c{j}")) for i, j in PAIRS}
    between = {c: share * (1 - share) * x for c, x in apart.items()}
    blended = own.join(named, "parent").select(
        "group",
        "n",
        *[(F.col(c) * share + F.col(f"p_{c}") * (1 - share) + between.get(c, F.lit(0.0))).alias(c) for c in numbers],
    )
    return materialize(blended.mapInPandas(run, ESTIMATE.replace("group string", "group string, n bigint")))


def with_verdict(stats: DataFrame, cutoff: float = CHI2_FAR, prior: float = PRIOR) -> DataFrame:
    """``stats`` (a written table with ``lang, source``) with ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    vector = [x.alias(f"x{i}") for i, x in enumerate(features())]
    passed = stats.where(~failed)
    rows = passed.select(F.explode(F.array(*group_keys())).alias("group"), *vector)
    estimate = concentrated(rows)
    far = rows.join(estimate, "group").withColumn("d", distance())
    scale = materialize(
        far.groupBy("group").agg((F.percentile_approx("d", 0.5, 1000) / CHI2_MEDIAN).alias("scale"))
    )
    near = far.join(scale, "group").where(F.col("d") <= CHI2_975 * F.greatest("scale", F.lit(1.0)))
    estimate = fitted(near, F.greatest(F.max("scale"), F.lit(1.0)))
    # Each language is drawn to all, each source of a language to what its language has become.
    every, language, own = group_keys()
    sizes = materialize(passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")))
    languages = sizes.groupBy("lang").agg(F.sum("n").alias("n")).select(language.alias("group"), every.alias("parent"), "n")
    cells = sizes.select(own.alias("group"), language.alias("parent"), "n")
    of_languages = drawn(languages.join(estimate, "group"), estimate, prior)
    of_cells = drawn(cells.join(estimate, "group"), of_languages, prior)
    judged = (
        stats.withColumn("own", own)
        .select("*", *vector)
        .join(of_cells.select(F.col("group").alias("own"), *CENTRE, *WHITE), "own", "left")
    )
    return judged.select(
        *stats.columns,
        failed.alias("base_failed"),
        (~failed & F.coalesce(distance() <= cutoff, F.lit(True))).alias("kept"),
    )


def quality_rules(docs: DataFrame, cutoff: float = CHI2_FAR, prior: float = PRIOR) -> DataFrame:
    """``doc_id, lang, source``, the statistics, ``base_failed`` and ``kept`` of each document."""
    stats = materialize(statistics(docs, ["doc_id", "lang", "source"]))
    return with_verdict(stats, cutoff, prior)


def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules(docs).select("doc_id", *STATISTICS, "base_failed", "kept")


QUERIES = {"op3_robust_outliers": (op3_robust_outliers, None)}
