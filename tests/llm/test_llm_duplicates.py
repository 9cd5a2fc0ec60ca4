"""Near-duplicates, repeated passages and nearest neighbours against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reviewlake.llm import components, near_dups, neighbours, substrings


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def shingle_set(text, width):
    w = (text or "").encode().translate(near_dups.FOLD).split()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_components(texts, width, percent):
    sets = [shingle_set(t, width) for t in texts]
    lead = list(range(len(texts)))

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    x, y = find(i), find(j)
                    lead[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def edited(rnd, base, n):
    out = list(base)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"e{rnd.randrange(10**6)}"
    return out


def corpus(seed):
    rnd = random.Random(seed)
    passage = words(rnd, 60)
    texts = []
    for g in range(25):
        base = words(rnd, rnd.randrange(60, 200))
        texts += [" ".join(edited(rnd, base, rnd.randrange(0, 6))) for _ in range(rnd.randrange(2, 6))]
    crowd = words(rnd, 150)
    texts += [" ".join(edited(rnd, crowd, rnd.randrange(1, 8))) for _ in range(150)]
    # Unlike documents with one passage in common, a chain, copies in other case, short and empty ones.
    texts += [" ".join(words(rnd, 100) + passage) for _ in range(60)]
    chain = words(rnd, 120)
    for step in range(20):
        chain = edited(rnd, chain, 1)
        texts.append(" ".join(chain))
    texts += [texts[0].upper(), texts[0].replace(" ", "\n\t"), texts[1], None, "", "  ", "a", "A", "a b", "a b c", "é", "É"]
    return texts


@pytest.mark.parametrize("width,percent", [(4, 80)])
def test_components_of_near_duplicates(spark, monkeypatch, width, percent):
    monkeypatch.setattr(near_dups, "LEAF", 16)
    monkeypatch.setattr(near_dups, "CROWD", 16)
    texts = corpus(width)
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, label int")
    lead, sizes = brute_components(texts, width, percent)
    got = near_dups.near_duplicates(df, width, percent / 100).orderBy("doc_id").collect()
    assert [r.n_shingles for r in got] == sizes
    assert [r.component_id for r in got] == lead
    kept = near_dups.one_of_each(df, width, percent / 100).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(lead))
    assert {r.doc_id: r.text for r in kept} == {i: texts[i] for i in set(lead)} and kept[0].label == 7


def test_links_within_an_unlinked_crowd(spark, monkeypatch):
    """Pairs at exactly 0.8 among documents alike at 0.75, where two trees alone miss many."""
    monkeypatch.setattr(near_dups, "LEAF", 16)
    monkeypatch.setattr(near_dups, "CROWD", 16)
    monkeypatch.setattr(near_dups, "CENTRES", 8)
    monkeypatch.setattr(near_dups, "LEVELS", 2)
    monkeypatch.setattr(near_dups, "STAGES", ((2, None, True),))
    monkeypatch.setattr(near_dups, "MISS", 1e-6, raising=False)
    common = [f"c{i}" for i in range(231)]
    texts = []
    for p in range(60):
        pair = [f"p{p}x{i}" for i in range(9)]
        texts += [" ".join(common + pair + [f"d{p}y{half}z{i}" for i in range(30)]) for half in range(2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_dups.near_duplicates(df, 1, 0.8).collect()
    assert all(r.component_id in (r.doc_id, r.doc_id // 2 * 2) for r in got)
    # Two trees leave some documents in shallow nodes alone, which get no further round.
    assert sum(r.component_id < r.doc_id for r in got) >= 54


@pytest.mark.parametrize("fine", [512, 60])
def test_pairs_of_a_crowd_are_not_handed_on(spark, monkeypatch, fine):
    monkeypatch.setattr(near_dups, "FINE", fine, raising=False)
    asked = []
    confirmed = near_dups.confirmed

    def counted(pairs, *others):
        asked.append(pairs.count())
        return confirmed(pairs, *others)

    monkeypatch.setattr(near_dups, "confirmed", counted)
    rnd = random.Random(5)
    passage = words(rnd, 84, 10**9)
    # Any two share 0.72 of their words; each fifth has a near copy.
    texts = [" ".join(passage + words(rnd, 16, 10**9)) for _ in range(150)]
    texts += [" ".join([*t.split()[:-2], "so", "on"]) for t in texts[::5]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = near_dups.near_duplicates(df, 1, 0.8).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == brute_components(texts, 1, 80)[0]
    # There are 16,110 pairs; some partners of each document are confirmed before all are looked at.
    assert sum(asked) < 4000 or fine < 100


@pytest.mark.parametrize("levels,found", [(3, 0.9986), (5, 0.987), (7, 0.963), (9, 0.931), (12, 0.879)])
def test_rounds_hold_the_target(levels, found):
    assert 1 - near_dups.missed(levels, 0.8) == pytest.approx(found, abs=6e-4)
    turns = 1
    while (level := near_dups.level_of_turn(turns, 0.8)) is not None and level <= levels:
        turns += 1
    assert near_dups.missed(levels, 0.8) ** turns <= near_dups.MISS


def test_null_and_repeated_ids(spark):
    same = "one two three four five six seven"
    rows = [(None, same), (5, same), (5, same), (4, same + " x"), (None, "alone in the world of words"), (9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dups.near_duplicates(df, 5, 0.7)
    # 3 of 4 shingles are common.
    assert Counter((r.doc_id, r.component_id) for r in got.collect()) == Counter([(None, 4), (5, 4), (5, 4), (4, 4), (None, None), (9, 9), (9, 9)])
    kept = near_dups.one_of_each(df, 5, 0.7).collect()
    assert Counter(r.doc_id for r in kept) == Counter([4, None, 9, 9])


def test_near_duplicates_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dups.near_duplicates(empty).count() == 0 and near_dups.one_of_each(empty).count() == 0


def test_components_of_links(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(200, 260)] + [(0, i) for i in range(1, 90)] + [(300, 300), (7, 500), (500, 501)]
    links += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(60)]
    got = {r.id: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    lead = {}

    def find(x):
        while lead.setdefault(x, x) != x:
            x = lead[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            lead[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in lead}


def brute_removed(texts, width):
    cut = [(t or "").encode().split() for t in texts]
    n = Counter(tuple(w[i : i + width]) for w in cut for i in range(len(w) - width + 1))
    out = []
    for w in cut:
        gone = {j for i in range(len(w) - width + 1) if n[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out.append((len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


@pytest.mark.parametrize("width,slice_size", [(35, 3_000), (50, 8_000_000)])
def test_repeated_passages(spark, monkeypatch, width, slice_size):
    monkeypatch.setattr(substrings, "SLICE", slice_size)
    rnd = random.Random(width)
    passages = [words(rnd, n) for n in (width - 1, width, width + 1, width + 20, 200)]
    texts = [None, "", "a b c", " ".join(["x"] * 200), " ".join(["x", "y"] * 60), " ".join(words(rnd, width))]
    for i in range(80):
        body = words(rnd, rnd.randrange(0, 90), 3000)
        for p in rnd.sample(passages, rnd.randrange(0, 3)):
            at = rnd.randrange(len(body) + 1)
            body[at:at] = p
        texts.append(("\n" if i % 3 else "  ").join(body))
    texts += [texts[-1], texts[-2], texts[-2].upper()]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(5)
    got = substrings.drop_repeated(df, ["doc_id"], width).orderBy("doc_id").collect()
    expected = brute_removed(texts, width)
    assert [(r.n_words, r.n_removed, r.kept) for r in got] == expected
    digests = substrings.drop_repeated(df, ["doc_id"], width, digest=True).orderBy("doc_id").collect()
    assert [r.kept for r in digests] == [hashlib.sha256(x.encode()).hexdigest() for _, _, x in expected]


def test_repeated_passages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.drop_repeated(empty, ["doc_id"]).count() == 0


def test_cover_takes_any_two_places_to_covered_ones():
    p = substrings.PERIOD
    for i in range(p):
        for j in range(p):
            assert any((i + d) % p in substrings.COVER and (j + d) % p in substrings.COVER for d in range(p))


def brute_nearest(rows, query, k=5):
    size = max(len(v) for v in rows.values())
    full = {i: np.array(list(v) + [0.0] * (size - len(v)), dtype=np.float64) for i, v in rows.items()}
    unit = {i: v / np.linalg.norm(v) for i, v in full.items()}
    return sorted(((-round(float(unit[query] @ u), 12), i) for i, u in unit.items() if i != query))[:k]


def test_nearest_on_a_small_table(spark):
    """A small table is searched whole: exact, with ties, equal vectors and all that takes no part."""
    rng = np.random.default_rng(0)
    good = {i: rng.integers(-3, 4, 6).astype(float).tolist() for i in range(400)}
    good = {i: v for i, v in good.items() if any(v)} | {1000 + i: [1.0, 2.0, 3.0] for i in range(30)}
    rows = [(i, v, "x") for i, v in good.items()] + [(0, good[0], "again"), (1050, None, ""), (1100, [0.0] * 6, ""), (1150, [], "")]
    rows += [(1200, [1.0, None], ""), (1250, [float("nan"), 1.0], ""), (1300, [float("inf")], ""), (None, [1.0] * 6, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    from pyspark.sql import functions as F

    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0, trees=4, search_rows=10_000).collect()
    queries = [i for i in good if i % 50 == 0]
    assert {r.query_id for r in got} == set(queries)
    for q in queries:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        expected = brute_nearest(good, q)
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([-s for s, _ in expected], [s for _, _, s in mine], atol=1e-12)
        # Cosines that differ in the last digit alone are ties in the brute force.
        assert {round(s, 9) for _, _, s in mine} == {round(-s, 9) for s, _ in expected}
    equal = sorted((r.rank, r.vec_id) for r in got if r.query_id == 1000)
    assert equal == [(1, 1001), (2, 1002), (3, 1003), (4, 1004), (5, 1005)]


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    from pyspark.sql import functions as F

    got = neighbours.nearest(table, F.col("vec_id") % 50 == 0, trees=32, search_rows=1400).collect()
    rows = {r.vec_id: r.embedding for r in table.collect() if r.embedding and any(r.embedding)}
    queries = [i for i in rows if i % 50 == 0]
    found = sum(len({i for _, i in brute_nearest(rows, q)} & {r.vec_id for r in got if r.query_id == q}) for q in queries)
    assert found / (5 * len(queries)) >= 0.9


@pytest.mark.parametrize("n", [4_000, 150_000])
def test_recall_as_in_production(spark, n):
    """Vectors without structure, with what ``op2`` takes by itself."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(n)
    vectors = rng.standard_normal((n, 48)).astype(np.float32)
    table = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(vectors)}))
    queries = np.arange(0, n, n // 200)
    got = neighbours.nearest(table, F.col("vec_id") % (n // 200) == 0).collect()
    full = vectors.astype(np.float64)
    full /= np.linalg.norm(full, axis=1, keepdims=True)
    cosines = full[queries] @ full.T
    cosines[np.arange(len(queries)), queries] = -1
    true = {(int(q), int(i)) for q, row in zip(queries, np.argsort(-cosines, axis=1)[:, :5]) for i in row}
    recall = len(true & {(r.query_id, r.vec_id) for r in got}) / len(true)
    assert recall >= 0.93


def test_nearest_of_few_or_no_rows(spark):
    from pyspark.sql import functions as F

    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0]), (1, [-1.0])], schema)
    assert [tuple(r) for r in neighbours.nearest(few, F.lit(True)).orderBy("query_id").collect()] == [(0, 1, 1, -1.0), (1, 1, 0, -1.0)]
    for rows in ([], [(0, [1.0])], [(0, None)]):
        assert neighbours.nearest(spark.createDataFrame(rows, schema), F.lit(True)).count() == 0


def test_classes_that_do_not_branch_hold_the_target():
    """Whatever share of the roots is crowded, and whether it is crowded by the other side's tokens."""
    assert near_dups.missed_at_roots(0.8) + near_dups.missed(1, 0.8) < near_dups.MISS
    rng = np.random.default_rng(5)
    for crowded in (0.0, 0.3, 0.6, 0.8):
        draw = rng.random((200_000, near_dups.TREES))
        ended, apart = draw >= crowded, draw >= 0.8
        lost = (ended.sum(axis=1) >= near_dups.ENOUGH * near_dups.TREES) & ~(ended & ~apart).any(axis=1)
        assert lost.mean() <= near_dups.missed_at_roots(0.8) + 2e-4


def test_copies_of_the_query_leave_room_for_equally_near_ones(spark):
    from pyspark.sql import functions as F

    rows = [(1, [1.0, 0.0]), (100, [1.0, 0.0]), *[(i, [float(i), 0.0]) for i in range(2, 7)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") == 1, trees=2, search_rows=100).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [2, 3, 4, 5, 6]


def test_a_task_hands_on_the_nearest_of_a_query_alone(spark, monkeypatch):
    rng = np.random.default_rng(7)
    items = [[(100 * b + i, [100 * b + i], rng.normal(size=4).tolist()) for i in range(20)] for b in range(30)]
    queries = [(q, rng.normal(size=4).tolist()) for q in (100_000, 100_001)]
    kind = "queries array<struct<query_id long, vector array<double>>>, items array<struct<item long, ids array<long>, vector array<double>>>"
    pairs = spark.createDataFrame([(queries, block) for block in items], kind).coalesce(1)
    for held in (neighbours.HELD, 50):
        monkeypatch.setattr(neighbours, "HELD", held)
        got = neighbours.ranked(pairs, 4, 5).collect()
        assert len(got) == 12
        for q, vector in queries:
            a = np.array(vector)
            cosines = {i: a @ np.array(v) / np.linalg.norm(a) / np.linalg.norm(v) for block in items for i, _, v in block}
            assert {r.item for r in got if r.query_id == q} == set(sorted(cosines, key=cosines.get)[-6:])
