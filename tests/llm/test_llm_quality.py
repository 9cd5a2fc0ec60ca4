"""Quality rules and the quality classifier."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from reviewlake.llm import outliers, quality

SF = "/root/testdata/sf0.01"
SPACES = " \t\n\x0b\f\r"


def plain_statistics(text):
    text = text or ""
    words = text.encode().split()
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += line in seen and bool(line.strip(SPACES))
        seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), again, len(covered)


def test_statistics(spark):
    texts = [None, "", " \n ", "one", "a b c d e a b c d e", "a b c d e " * 400, "é è\x1c ê\xa0x #*$%&|<>", "x\ny\nx\n\n\n x", "a a a a a a"]
    texts += ["a b c d", "l\r\nl\r\nl", "w\x0bw\x0cw " * 9]
    df = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = outliers.statistics(df, ["doc_id"]).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [plain_statistics(t) for t in texts]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    expected = {r.doc_id: plain_statistics(r.text) for r in docs.collect()}
    assert {r[0]: tuple(r)[1:] for r in outliers.statistics(docs, ["doc_id"]).collect()} == expected


def test_estimates_ignore_planted_outliers(spark):
    """Centre and verdicts with a fifth of far outliers, against numpy on the clean rows."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(1000):
        far = i % 5 == 0
        n = int(rng.integers(100, 400))
        rows.append((i, "en", "s", n, int(n * rng.normal(9 if far else 5, 0.2)), n if far else 0, 0, 0))
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in outliers.STATISTICS)
    got = outliers.with_verdict(spark.createDataFrame(rows, schema)).orderBy("doc_id").collect()
    assert all(not r.kept for r in got if r.doc_id % 5 == 0)
    assert all(r.kept for r in got if r.doc_id % 5)


def test_concentration_finds_the_least_determinant(spark):
    """Of twelve vectors, the nine that enclose the least, among all choices of nine."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 0.5, (9, 4)), rng.normal(4, 1.5, (3, 4))])
    floor = np.diag(np.square(outliers.FLOORS))
    det = lambda some: np.linalg.det(np.cov(x[list(some)].T, bias=True) + floor)
    best = min(combinations(range(12), 9), key=det)
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "group string, x0 double, x1 double, x2 double, x3 double")
    got = outliers.concentrated(rows).first()
    assert [got[c] for c in outliers.CENTRE] == pytest.approx(x[list(best)].mean(axis=0).tolist())
    expected = np.cov(x[list(best)].T, bias=True) + floor
    assert [got[c] for c in outliers.COVARIANCE] == pytest.approx([expected[i, j] for i, j in outliers.PAIRS])


def test_verdicts_do_not_jump_with_the_size_of_a_group(spark):
    """A small source of its own style, judged by itself at any size, and within a larger table."""
    rng = np.random.default_rng(3)

    def rows(source, n, length, start):
        words = rng.integers(100, 400, n).tolist()
        return [(start + i, "en", source, w, int(w * rng.normal(length, 0.15)), 0, 0, 0) for i, w in enumerate(words)]

    large, small = rows("large", 1500, 5, 0), rows("small", 201, 8, 10_000)
    odd = [(20_000, "en", "small", 300, 300 * 14, 300, 0, 0)]
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in outliers.STATISTICS)
    kept = []
    for n in (20, 199, 200, 201):
        df = spark.createDataFrame(large + small[:n] + odd, schema)
        kept.append({r.doc_id for r in outliers.with_verdict(df).where("kept and source = 'small'").collect()})
        assert 20_000 not in kept[-1] and len(kept[-1]) >= 0.97 * n
    assert kept[1] & {r[0] for r in small[:199]} == kept[2] & {r[0] for r in small[:199]}


def test_rules_on_labelled_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = outliers.quality_rules(docs).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    good = got[(got.quality == 1) & ~got.base_failed]
    assert good.kept.mean() > 0.99 and got[got.quality == 0].kept.mean() < 0.1
    assert not got[got.base_failed].kept.any()


def test_small_groups_nulls_and_empty_tables(spark):
    rows = [(1, None, None, None), (2, "w " * 20, None, "s"), (3, "a b c d e f g h i j k", "en", None), (3, "a b c d e f g h i j k", "en", None)]
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, lang string, source string, KEPT boolean")
    got = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in outliers.quality_rules(df).collect()}
    assert got == {1: (0, True, False), 2: (20, True, False), 3: (11, False, True)}
    assert outliers.quality_rules(df).count() == 4
    assert outliers.quality_rules(df.where("false")).count() == 0


def test_groups_of_null_language_are_judged(spark):
    rows = [(i, "some plain words of text " + f"number{i} " * 1 + "and more of it too", None, None) for i in range(300)]
    rows.append((999, "#### " * 3 + "| ".join("abcdefghijklm"), None, None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in outliers.quality_rules(df).collect()}
    assert not got.pop(999) and all(got.values())


def test_held_out_classifier(spark):
    got = quality.op4_neighbour_votes(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert (good.score.to_numpy()[:, None] > bad.score.to_numpy()).mean() > 0.97
    assert good.predicted.mean() > 0.97 and bad.predicted.mean() < 0.15


def test_scores_are_exact_neighbour_votes():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"ab cd!\n"), 60).tolist()) for _ in range(80)]
    model = quality.Neighbours.learn(quality.term_vectors(texts[:50]), np.arange(50) % 2 * 1.0, 8)
    terms = quality.term_vectors(texts[50:])
    latent = model.latent(terms).astype(np.float64)
    for row, score in zip(latent, model.scores(terms, 7)):
        cosine = model.vectors.astype(np.float64) @ row
        near = np.argsort(-cosine)[:7]
        w = np.maximum(cosine[near], 0) ** 2 + 1e-9
        assert score == pytest.approx((w * model.labels[near]).sum() / w.sum(), abs=1e-4)


def test_classifier_special_cases(spark):
    rows = [(1, "good plain words"), (2, "bad!! BAD!! BAD!!"), (3, None), (4, ""), (None, "x"), (2, "bad!! BAD!! BAD!!")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, Score double")
    marks = [(1, 1), (1, 1), (2, 0), (2, 1), (None, 1), (3, None), (99, 1), (4, 7)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.learn(docs, labels)
    assert sorted(model.labels) == [0, 1]
    got = quality.score(docs, model, ["doc_id"]).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[1] > 0.5 > by_id[2]
    unlearned = quality.learn(docs, labels.where("false"))
    assert {r.score for r in quality.score(docs, unlearned, ["doc_id"]).collect()} == {0.5}
    assert quality.score(docs.where("false"), model, ["doc_id"]).count() == 0
