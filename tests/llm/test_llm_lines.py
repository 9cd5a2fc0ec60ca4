"""Line dedup against brute force."""

from collections import Counter

from reviewlake.llm.line_dedup import drop_frequent_lines

SPACES = " \t\n\x0b\f\r"
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(texts, min_docs, min_chars):
    lines = [(t or "").split("\n") for t in texts]
    keys = [[x.strip(SPACES).translate(FOLD) for x in ls] for ls in lines]
    n = Counter(k for ks in keys for k in set(ks) if len(k) >= min_chars)
    out = []
    for ls, ks in zip(lines, keys):
        left = [x for x, k in zip(ls, ks) if n[k] < min_docs]
        out.append(("\n".join(left), len(ls), len(ls) - len(left)))
    return out


def test_against_brute_force(spark):
    texts = ["Shared\nown %d\n\n shared " % i for i in range(12)] + ["SHARED\t", None, "", "\n\n", "É\né", "a\r\nb"]
    texts += ["É"] * 12 + ["é"] * 9 + ["rare"] * 9 + ["\n".join(f"l{i}" for i in range(5000)) + "\nshared"]
    texts += ["x\x1c", "x\xa0", "x"] * 5
    rows = [(i if i % 7 else None, t, "c", 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Lines string, extra int")
    got = drop_frequent_lines(df)
    assert set(got.columns) == {"doc_id", "extra", "text", "n_lines", "n_dropped"}
    expected = [(r[0], *b) for r, b in zip(rows, brute(texts, 10, 1))]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == Counter(expected)


def test_thresholds_and_empty_lines(spark):
    texts = ["ab\n\nxy"] * 3 + ["ab\n\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = drop_frequent_lines(df, min_docs=4, min_chars=3).collect()
    assert all(r.n_dropped == 0 for r in got)
    got = drop_frequent_lines(df, min_docs=4, min_chars=0).orderBy("doc_id").collect()
    assert [(r.text, r.n_dropped) for r in got] == [("xy", 2)] * 3 + [("", 3)]


def test_empty_table(spark):
    assert drop_frequent_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
