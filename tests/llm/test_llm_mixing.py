"""Mixing against an iterative reshare, and its special cases."""

import pytest
from pyspark.sql import functions as F

from reviewlake.llm import mixing

SCHEMA = "doc_id long, text string, source string, SIZE string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def reshared(sizes, share=1.5, most=2.0):
    """Targets, by giving the excess of full sources to the others until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = dict(zip(names, [3, 1, 2] * len(names)))
    wanted, free = share * sum(sizes.values()), set(names)
    out = {n: most * sizes[n] for n in names}
    while free:
        rest = wanted - sum(most * sizes[n] for n in names if n not in free)
        total = sum(weight[n] for n in free)
        full = {n for n in free if rest * weight[n] / total > most * sizes[n]}
        if not full:
            return out | {n: rest * weight[n] / total for n in free}
        free -= full
    return out


def test_targets_and_taken_words(spark):
    rows = [(i, "w " * (i % 40 + 1), "abcdeé"[i % 6] if i % 6 else None) for i in range(300)]
    rows += [(1000 + i, "w " * 500, "b") for i in range(20)] + [(2000, None, "a"), (2001, "", "zero"), (5, "x y", "b")]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    sizes, taken, target = {}, {}, {}
    for r in got:
        s = r.source
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.taken for c in r.copies)
        assert all(0 <= c.position <= 1 for c in r.copies)
    assert set(source.values()) <= set(sizes)
    expected = reshared(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s], abs=1e-6)
        assert abs(taken[s] - target[s]) <= 0.5
    again = mixing.mix(docs(spark, rows[::-1])).select("doc_id", "taken").collect()
    assert sorted(again) == sorted((r.doc_id, r.taken) for r in got)


def test_positions_follow_the_schedule(spark):
    """A source whose weight falls has most of its words early; half its demand is due where its integral is half."""
    rows = [(i, "w", "a") for i in range(400)] + [(1000 + i, "w", "b") for i in range(400)]
    got = mixing.training_order(mixing.mix(docs(spark, rows), share=0.5)).select("source", "position").collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    early = sum(r.source == "a" and r.position < 0.5 for r in got) / sum(r.source == "a" for r in got)
    # The integral of 4.5 - 3t up to 1/2 is 1.875 of 3.
    assert early == pytest.approx(1.875 / 3, abs=0.01)


def test_due_inverts_a_schedule_of_several_pieces(spark):
    schedule = ((0.0, 0.0), (0.25, 2.0), (0.5, 2.0), (0.75, 0.0), (1.0, 1.0))
    parts = spark.range(0, 101).select((F.col("id") / 100).alias("y"))
    for y, t in parts.select("y", mixing.due(schedule, F.col("y"))).collect():
        area = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            end = min(max(t, t0), t1)
            slope = (w1 - w0) / (t1 - t0)
            area += (w0 + w0 + slope * (end - t0)) / 2 * (end - t0)
        assert area == pytest.approx(y * mixing.integral(schedule), abs=1e-9)


def test_cut_copy_has_its_first_words(spark):
    rows = [(1, " one two\tthree  four five six", "a"), (2, "w " * 6, "b")]
    # 4 words for a and 2 for b.
    got = mixing.training_order(mixing.mix(docs(spark, rows), schedules=mixing.SCHEDULES[:1] + mixing.SCHEDULES[2:], share=0.5))
    one = next(r for r in got.collect() if r.doc_id == 1)
    assert one.taken == len(one.text.split()) < 6 and " one two\tthree  four five six".startswith(one.text)


def test_empty_table(spark):
    empty = docs(spark, [])
    assert mixing.mix(empty).count() == 0 and mixing.training_order(mixing.mix(empty)).count() == 0


def test_only_empty_texts(spark):
    got = mixing.mix(docs(spark, [(None, None, None), (1, " ", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("bad", [((0.0, 1.0), (0.0, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, -1.0), (1.0, 3.0))])
def test_bad_schedules(bad):
    with pytest.raises(ValueError):
        mixing.segments(bad)
