"""Repair of conversations: the search, the chaining of pieces and whole results against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest

from reviewlake.llm.conversations import (
    START, STATES, TAIL, Row, Ways, NO_ROWS, INSERT, audit, carried_out, cheapest, cut, damaged, marked, repair,
)

SPACES = " \t\n\x0b\f\r"


def brute(rows):
    """Cheapest first, then least, all edits there are."""
    heap = [(0, "", 0, "")]
    while True:
        cost, edits, at, initials = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, edits
        options = [("I", 3, at, "u"), ("I", 3, at, "a")]
        if at < len(rows):
            row = rows[at]
            options.append(("D" * row.times, 4 * row.times, at + 1, ""))
            if not row.must_go:
                more = 3 * row.truncated
                options += [("R", 3 + more, at + 1, "u"), ("R", 3 + more, at + 1, "a")]
                options += [("K", more, at + 1, row.role[:1])] * bool(row.role)
        for edit, more, next_at, initial in options:
            if re.fullmatch("s?(ua)*u?", initials + initial):
                heapq.heappush(heap, (cost + more, edits + edit, next_at, initials + initial))


def by_tables(rows):
    """The same, row by row: the best edits up to each beginning of the order."""
    best = {"": (0, "")}
    for row in [*rows, None]:
        spread = {}
        for initials, (cost, edits) in best.items():
            for n in range(3):
                spread[initials] = min(spread.get(initials, (cost, edits)), (cost, edits))
                initials = "u" if initials in ("", "s", "a") else "a"
                cost, edits = cost + 3, edits + "I"
        if row is None:
            return min(v for k, v in spread.items() if k in ("", "a"))
        best = {}
        for initials, (cost, edits) in spread.items():
            due = "a" if initials == "u" else "u"
            more = 3 * row.truncated
            options = [(initials, 4 * row.times, "D" * row.times)]
            if not row.must_go:
                options.append((due, 3 + more, "R"))
                if row.role[:1] == due or row.role[:1] == "s" and not initials:
                    options.append((row.role[:1], more, "K"))
            for after, c, e in options:
                best[after] = min(best.get(after, (9e9, "")), (cost + c, edits + e))


def some_rows(rng, most=7):
    out = []
    for _ in range(rng.randrange(1, most)):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
        must_go = rng.random() < 0.2
        out.append(Row(role, "t", must_go, not must_go and rng.random() < 0.3, rng.choice([1, 3]) if must_go else 1))
    return out


def test_search_and_chains_against_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        rows = some_rows(rng)
        expected = brute(rows)
        assert cheapest(rows) == by_tables(rows) == expected
        cost, out = carried_out(rows, expected[1], START)
        assert cost == expected[0] and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
        for most in (1, 2, 4):
            so_far, chain = NO_ROWS, []
            for at in range(0, len(rows), most):
                found = [cheapest(rows[at : at + most], p, q) for p in STATES for q in STATES]
                so_far, back = so_far.then(Ways.of(found))
                chain.append((found, back))
            ends = [(so_far.costs[q] + INSERT * len(TAIL[q]), so_far.order[q], q) for q in STATES if so_far.costs[q] >= 0]
            cost, _, state = min(ends)
            edits = TAIL[state]
            for found, back in reversed(chain):
                edits, state = found[4 * back[state] + state][1] + edits, back[state]
            assert (cost, edits) == expected


def test_no_way():
    assert cheapest([Row("user", "x")], 2, START) is None
    assert cheapest([Row("user", "x")], START, 1) is None
    assert cheapest([Row("system", "x"), Row("user", "x")], START, 1) == (4, "KD")


def whole(conversations):
    """Verdicts of damaged rows ``conv_id, turn, role, text``, all in one place."""
    out = {}
    for key in {c for c, *_ in conversations}:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in conversations if c == key]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        rows, seen, n = [], set(), Counter()
        for _, role, text in own:
            shown = text.strip(SPACES)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else ""
            fault = fault or ("" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
            n[fault] += 1
            rows.append(Row(role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a.role[:1] + b.role[:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, edits = by_tables(rows)
        lines = "\n".join(f"{r}:{x}" for r, x in carried_out(rows, edits, START)[1])
        digest = hashlib.sha256(lines.encode()).hexdigest()
        out[key] = (gaps, n["blank"], n["duplicate"], n["truncated"], bad, cost, edits, digest)
    return out


def verdicts(df, given=None, most=64):
    return {r[0]: tuple(r)[1:] for r in audit(given if given is not None else df, df, most).collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn int, role string, text string, part int")


@pytest.mark.parametrize("most", [2, 64])
def test_against_brute_force(spark, most):
    rng = random.Random(most)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "bot"])
            text = rng.choice(["One.", "Two", "Two. ", "É?\n", None, "", " \t", "Three!", "Four. five"])
            turn = rng.choice([turn, turn, turn + 2, None, 3])
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 2])
    # Longer than what one task gets, alone and among equal rows.
    rows += [(1000, t, "user" if t % 3 else "assistant", f"Text {t % 40}.") for t in range(700)]
    rows += [(1001, None, "user", "Same.")] * 300 + [(1002, 1, "system", "Only.")]
    df = frame(spark, rows).repartition(5)
    expected = whole(rows)
    assert verdicts(df, most=most) == expected
    made = repair(marked(df), most).where("conv_id = 1002").collect()
    assert [r.repaired for r in made] == [[]] or made[0].edits in ("D", "KII")


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b! c") for c in (*range(40), None) for t in (0, 1, None)]
    expected = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "A b c"}.get(kind, text)
        expected[c, t, "user" if kind == 4 else role, text] += {0: 0, 3: 2}.get(kind, 1)
    assert Counter(map(tuple, damaged(frame(spark, rows)).collect())) == +expected


def test_nothing_left(spark):
    rows = [(1, 0, "user", ""), (1, 1, "user", None), (2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    df, none = frame(spark, rows), hashlib.sha256().hexdigest()
    assert verdicts(df)[1] == (0, 2, 0, 0, 1, 8, "DD", none)
    assert verdicts(df)[2][:7] == (0, 0, 0, 0, 0, 0, "KK")
    assert verdicts(df.where("conv_id = 2"), df)[1] == (0, 0, 0, 0, 0, 0, "", none)
    assert verdicts(df.limit(0)) == {}


def test_pieces_of_a_task():
    rows = [dict(conv_id=c, role="user", text="x", must_go=g, truncated=False, copies=n) for c, g, n in
            [(1, False, 1), (2, False, 5), (3, True, 10**9), (3, False, 1), (3, False, 1), (4, False, 1)]]
    got = [(r["conv_id"], r["piece"], r["whole"], [x["times"] for x in r["rows"]], r["illegal"]) for r in cut(iter(rows), 0, 2)]
    assert got == [(1, 0, False, [1], 0), (2, 0, True, [1, 4], 4), (3, 0, False, [10**9, 1], 10**9),
                   (3, 1, False, [1], 0), (4, 0, False, [1], 0)]
