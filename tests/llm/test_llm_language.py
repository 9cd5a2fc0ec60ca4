"""Language identification: code lengths by a plain model, held-out accuracy, special cases."""

import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import language

SF = "/root/testdata/sf0.01"


def plain_cost(samples, text, order):
    """Bits of ``text`` after learning ``samples``, byte by byte."""
    seen = defaultdict(Counter)
    for sample in samples:
        data = b"\n" * order + sample
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[data[i - k : i]][data[i]] += 1
    data, bits = b"\n" * order + text, 0.0
    for i in range(order, len(data)):
        for k in range(order, -2, -1):
            if k < 0:
                bits += 8
                break
            after = seen.get(data[i - k : i])
            if after is None:
                continue
            whole = sum(after.values()) + len(after)
            if data[i] in after:
                bits -= math.log2(after[data[i]] / whole)
                break
            bits -= math.log2(len(after) / whole)
    return bits


@pytest.mark.parametrize("order", [0, 1, 2, 3, 5])
def test_code_lengths(order):
    samples = {"b": [b"the cat sat on the mat", b"then"], "a": ["der Käse läuft".encode(), b"das"]}
    rows = []
    for lang, texts in samples.items():
        for text in texts:
            data = np.concatenate([np.frombuffer(b"\n" * order, np.uint8), np.frombuffer(text, np.uint8)])
            for k in range(order + 1):
                keys, n = np.unique(language.packed(data[order - k :], k), return_counts=True)
                rows += [(lang, k, int(x), int(c)) for x, c in zip(keys, n)]
    counts = pd.DataFrame(rows, columns=["lang", "order", "key", "n"]).groupby(["lang", "order", "key"]).sum().reset_index()
    trees = language.ContextTrees(counts, order)
    texts = [b"the mat", "Käse".encode(), b"", b"\x00zz", b"a" * 50]
    assert trees.languages == ["a", "b"]
    expected = [[plain_cost(samples[lang], t, order) for lang in "ab"] for t in texts]
    assert np.allclose(trees.code_lengths(texts), expected, rtol=1e-5)


def test_long_texts_are_scored_whole(monkeypatch):
    rows = [("x", 0, b, 1) for b in range(97, 107)] + [("x", 1, (a << 8) + b, 1) for a in range(97, 107) for b in range(97, 107)]
    trees = language.ContextTrees(pd.DataFrame(rows, columns=["lang", "order", "key", "n"]), 1)
    texts = [b"abc" * 700, b"", b"j", b"zz" * 999]
    whole = trees.code_lengths(texts)
    monkeypatch.setattr(language, "BLOCK", 64)
    assert np.allclose(trees.code_lengths(texts), whole)


def test_held_out_accuracy(spark):
    got = language.op9_language(spark, SF).where("held_out")
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = got.join(truth, "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok")).toPandas()
    assert len(right) > 150 and right.ok.mean() > 0.99


def test_special_cases(spark):
    rows = [(1, "hello world", "en"), (2, "bonjour monde", "fr"), (3, None, "en"), (4, "", "fr"), (5, "123 !?", "en")]
    rows += [(6, "hello", None), (7, "日本", None), (None, "world", None), (1, "hello world", "en")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, SCORE double")
    got = language.identify(df, language.learn(df))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    pred = [(r.doc_id, r.lang_pred) for r in got.collect()]
    assert pred[:6] == [(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (6, "en")]
    assert pred[6][1] in ("en", "fr") and pred[7:] == [(None, "en"), (1, "en")]
    assert all(0 <= r.score <= 1 for r in got.collect())


def test_nothing_learned_and_empty_table(spark):
    df = spark.createDataFrame([(1, "hello", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(df, language.learn(df)).collect()] == [("und", 0.0)]
    empty = df.where("false")
    assert language.identify(empty, language.learn(empty)).count() == 0
