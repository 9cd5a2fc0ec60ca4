"""Ranked search against brute force, and the mined plans against plain sums."""

import math
import random
import re
from collections import Counter

import numpy as np

from reviewlake.llm import search
from reviewlake.llm.search import frequent_pairs, item_scores, mined

FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return re.findall(search.TERM, (text or "").translate(FOLD))


def brute(docs, items, k=10):
    counts = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    for item, own in wanted.items():
        found = []
        for (doc, _), c, n in zip(docs, counts, sizes):
            if n:
                m = 100 - 90 + (90 * n * n_docs) // n_terms
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in own
                    if t in c
                )
                if score > 0:
                    found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, k=10):
    docs = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string")
    items = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    return sorted(map(tuple, search.search(docs, items, k).collect()), key=str)


def corpus(rng, n, words):
    return [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "naïve", "A-b", "x_y", "9"]
    docs = corpus(rng, 300, words) + [(None, "w1 w2"), (7, None), (8, ""), (9, "--- !!"), (3, "w5"), (3, "w5")]
    docs += [(1000 + i, "W5 w6") for i in range(150)] + [(5000, "w1 " * 50_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 25)))) for i in range(30)]
    items += [(40, None), (41, ""), (42, "w5 w6"), (42, "w7"), (None, "w1"), (43, "unheard of"), (2**60 + 1, "w9")]
    got = ranked(spark, docs, items)
    assert got == brute(docs, items)
    assert {r[0] for r in got} >= {None, 42, 2**60 + 1}


def test_blocks_of_items(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    docs, items = corpus(rng, 80, words), corpus(rng, 25, words)
    monkeypatch.setattr(search, "BLOCK_TERMS", 60)
    monkeypatch.setattr(search, "CELLS", 500)
    assert ranked(spark, docs, items, 3) == brute(docs, items, 3)


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == []
    assert ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, None)], [(1, "a")]) == []


def test_shared_sets_are_summed_once():
    own = [list("abcdxy"), list("abcdz"), list("abq"), list("cdq"), list("abcd")]
    plan = mined(list(range(5)), own)
    # a b and c d always stand together: two leaves, and one node for both, which three items use.
    assert len(set(plan.leaf)) == 5 and plan.levels
    assert [len(p) for p in plan.parts] == [2, 2, 2, 2, 1]
    weight = np.arange(1, len(plan.terms) + 1)
    doc, term = np.divmod(np.arange(3 * len(plan.terms)), len(plan.terms))
    tf, m = np.full(len(doc), 2), np.array([10, 20, 30])
    part = 2_000_000_000 // (2000 + 8 * m)
    for terms_of, scores in zip(own, item_scores(plan, weight, doc, term, tf, m)):
        assert scores.tolist() == [sum(weight[plan.terms.index(t)] for t in terms_of) * p for p in part]


def test_fewer_sums_than_terms():
    rng = random.Random(3)
    groups = [[f"{g}.{i}" for i in range(10)] for g in range(12)]
    own = [sum((groups[g] for g in rng.sample(range(12), 5)), []) for _ in range(50)]
    plan = mined(list(range(50)), own)
    inner = plan.n_nodes - len(set(plan.leaf))
    assert inner + sum(len(p) - 1 for p in plan.parts) < 0.1 * sum(map(len, own))


def test_pairs_take_each_node_once():
    assert frequent_pairs(9, [{1, 2, 3}, {1, 2, 3}, {2, 3}, {1}, set()]) == [(2, 3)]
    assert frequent_pairs(9, []) == []
