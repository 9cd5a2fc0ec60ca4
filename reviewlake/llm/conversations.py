"""Repair of the turn structure of conversations, by the cheapest edits.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``: at most one
system message, then pairs of user and assistant. Each row is kept, given another role,
or deleted, and empty user or assistant rows may be inserted anywhere. Blank rows and rows
that repeat an earlier one must be deleted, and a truncated row that stays costs extra. Of
the cheapest lists of edits, the one whose initials come first in ASCII is taken.

The search is iterative-deepening A* (``cheapest``). Costs are counted in halves, so that
what remains can be bounded from below by charging each pair of equal roles to its edits.

**Long conversations.** Nothing needs all rows of a conversation in one place, but what by
its nature does (the digest of all its text, and the one string of its edits):

* Equal rows of a turn are counted before the shuffle, and the copies are one element of
  the search, with a number. Where a text was seen first is an aggregate as well.
* Rows are sorted by range, so that a long conversation spreads over many tasks. Each task
  cuts it into pieces of at most ``PIECE`` rows.
* What is a whole conversation in one piece, which nearly all are, is searched at once. Of
  other pieces the cheapest edits are searched between any two states of the order, of
  which there are four. Such results can be chained: a piece's edits end with that of its
  last row, so that of two lists neither begins with the other, and which one is least is
  decided in the piece, whatever follows. A task chains the pieces of its part of a
  conversation; the parts, at most one per task, are then chained to one choice, and each
  part's pieces are walked backwards along it.

Defined results: a null role or text is one space; a role without text has no initial and
can't be kept; rows of one turn come by role and by the
digest of their text, null turns first; a null ``conv_id``
is a conversation; all rows blank or repeated: all are deleted, and nothing is left; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from ..scratch import materialize
from .common import table

#: Most rows of a piece.
PIECE = 64
# What edits cost, and what a truncated row adds that is not deleted.
RETITLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the order: nothing yet, after the system message, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: From each state, the one after the next user's or assistant's message, whichever is due.
DUE = (USER, USER, ASSISTANT, USER)
NAME = {USER: "user", ASSISTANT: "assistant"}
#: What must be inserted after the last row, by state.
TAIL = ("", "II", "I", "")
NEVER = float("inf")


class Row(NamedTuple):
    """A row, or ``times`` rows that must be deleted."""

    role: str
    text: str
    must_go: bool = False
    truncated: bool = False
    times: int = 1

    @property
    def state(self) -> int | None:
        """The state after the row as it is, if it can stand."""
        return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(self.role[:1])


def least_ahead(rows: list[Row]) -> tuple[list[int], list[bool], list[tuple[int | None, int]]]:
    """For what is left from each row on, in halves, a bound of its cost after the start.

    Also whether a system message is left that can be kept, and the state of the first row
    that may stay, with what it is charged if another state is due.

    A row that can't stay as it is costs its cheapest edit. Two neighbours of the same role
    need an edit at one of them; half of the cheapest edit of a row (a deletion that saves
    the extra cost of a truncated one, or else a new role) is charged to each of its two
    pairs, so that the charges of any edits do not add up to more than these cost.
    """
    bound, system, first = [0], [False], [(None, 0)]
    for row in reversed(rows):
        ahead, charge = first[-1]
        if row.must_go:
            bound.append(bound[-1] + 2 * DELETE * row.times)
            system.append(system[-1])
            first.append(first[-1])
        elif row.state in (USER, ASSISTANT):
            own = 1 if row.truncated else 3
            pair = min(own, charge) if row.state == ahead else 0
            bound.append(bound[-1] + 2 * TRUNCATED * row.truncated + pair)
            system.append(system[-1])
            first.append((row.state, own))
        else:
            bound.append(bound[-1] + 2 * (DELETE if row.truncated else RETITLE))
            system.append(system[-1] or row.state == SYSTEM)
            first.append((None, 0))
    return bound[::-1], system[::-1], first[::-1]


def cheapest(rows: list[Row], entry: int = START, exit: int | None = None) -> tuple[int, str] | None:
    """Cost and initials of the cheapest edits that lead from one state to another.

    Without ``exit``: to the end of a conversation in order, rows inserted after the last
    one included. None if there is no way.

    Depth first, edits in ASCII order (delete, insert, keep, retitle), under a bound that
    rises to the least estimate beyond it. States in which a search failed under the bound
    are not searched again at the same cost or more. The bound never passes the least cost,
    so the first way that is found is the least of the cheapest.
    """
    ahead, system, first = least_ahead(rows)

    def estimate(at: int, state: int) -> float:
        if exit == START and state != START:
            return NEVER
        if exit == SYSTEM and not (state == SYSTEM or state == START and system[at]):
            return NEVER
        due, charge = first[at]
        least = ahead[at] + (charge if due is not None and due != DUE[state] else 0)
        # A system message that is kept spares its edit.
        return max(0, least - 2 * RETITLE) if state == START and system[at] else least

    def found(at: int, state: int, cost: int) -> bool:
        nonlocal beyond
        total = cost + estimate(at, state)
        if total > bound:
            beyond = min(beyond, total)
            return False
        if failed.get((at, state), NEVER) <= cost:
            return False
        # Stands while it is searched, too: a way back to this state can't be cheaper.
        failed[at, state] = cost
        if at == len(rows):
            if exit is not None:
                return state == exit
            return state in (START, ASSISTANT) or taken("I", at, DUE[state], cost + 2 * INSERT)
        row = rows[at]
        if taken("D" * row.times, at + 1, state, cost + 2 * DELETE * row.times):
            return True
        if taken("I", at, DUE[state], cost + 2 * INSERT):
            return True
        if row.must_go:
            return False
        cost += 2 * TRUNCATED * row.truncated
        fits = row.state == DUE[state] or row.state == SYSTEM and state == START
        if fits and taken("K", at + 1, row.state, cost):
            return True
        return taken("R", at + 1, DUE[state], cost + 2 * RETITLE)

    def taken(edit: str, at: int, state: int, cost: int) -> bool:
        edits.append(edit)
        if found(at, state, cost):
            ended.append(cost)
            return True
        edits.pop()
        return False

    bound = estimate(0, entry)
    while bound < NEVER:
        beyond, failed, edits, ended = NEVER, {}, [], []
        if found(0, entry, 0):
            return (ended[0] if ended else 0) // 2, "".join(edits)
        bound = beyond
    return None


def carried_out(rows: list[Row], edits: str, state: int) -> tuple[int, list[tuple[str, str]]]:
    """What the edits cost, and the roles and texts after them."""
    cost, out, at, rest = 0, [], 0, iter(rows)
    while at < len(edits):
        edit = edits[at]
        if edit == "I":
            state, at = DUE[state], at + 1
            out.append((NAME[state], ""))
            cost += INSERT
            continue
        row = next(rest)
        at += row.times
        if edit == "D":
            cost += DELETE * row.times
            continue
        state = row.state if edit == "K" else DUE[state]
        out.append((row.role if edit == "K" else NAME[state], row.text))
        cost += TRUNCATED * row.truncated + RETITLE * (edit == "R")
    return cost, out


class Ways(NamedTuple):
    """The cheapest ways between states: cost, and order among those of the same entry.

    Both are lists of 16, by entry and exit; no way has a cost of -1.
    """

    costs: list[int]
    order: list[int]

    @classmethod
    def of(cls, found: list[tuple[int, str] | None]) -> Ways:
        return cls([f[0] if f else -1 for f in found], ranked([f and f[1] for f in found]))

    def then(self, after: Ways) -> tuple[Ways, list[int]]:
        """Both in a row, and the state between them of each way."""
        costs, keys, between = [-1] * 16, [None] * 16, [-1] * 16
        for entry in STATES:
            for exit in STATES:
                ways = [
                    (self.costs[4 * entry + m] + after.costs[4 * m + exit], self.order[4 * entry + m], m)
                    for m in STATES
                    if self.costs[4 * entry + m] >= 0 and after.costs[4 * m + exit] >= 0
                ]
                if ways:
                    cost, order, m = min(ways)
                    costs[4 * entry + exit], between[4 * entry + exit] = cost, m
                    keys[4 * entry + exit] = (order, after.order[4 * m + exit])
        return Ways(costs, ranked(keys)), between


def ranked(keys: list) -> list[int]:
    """The place of each of 16 keys among the four of its entry, -1 for none."""
    entries = [sorted(k for k in keys[at : at + 4] if k is not None) for at in range(0, 16, 4)]
    return [-1 if k is None else entries[i // 4].index(k) for i, k in enumerate(keys)]


#: Stays in its state, at no cost.
NO_ROWS = Ways.of([(0, "") if p == q else None for p in STATES for q in STATES])

_ROW = "struct<role: string, text: string, must_go: boolean, truncated: boolean, times: bigint>"
_WAYS = "ways array<string>, back array<int>, costs array<bigint>, order array<int>"


def _schema(id_type: DataType, rest: str) -> StructType:
    return StructType([StructField("conv_id", id_type), *StructType.fromDDL(rest).fields])


def _batches(rows: Iterator[dict], schema: StructType, size: int = 500) -> Iterator[pa.RecordBatch]:
    arrow, held = to_arrow_schema(schema), []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held = []
    yield pa.RecordBatch.from_pylist(held, arrow)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


def pieces(rows: DataFrame, most: int = PIECE) -> DataFrame:
    """The ``marked`` rows in pieces, ordered by ``part, conv, piece``; whole conversations with their edits."""
    rest = f"part int, conv int, piece int, whole boolean, edits string, illegal bigint, rows array<{_ROW}>, {_WAYS}"
    schema = _schema(rows.schema["conv_id"].dataType, rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(cut(_rows(batches), TaskContext.get().partitionId(), most), schema)

    # Not the text: what separates the ranges is taken from a sample that the driver holds.
    order = ["conv_id", "turn", "role", "digest"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def cut(rows: Iterator[dict], part: int, most: int) -> Iterator[dict]:
    """The pieces of a task's sorted rows, of at most ``most`` rows."""
    held: list[Row] = []
    key, conv, piece, so_far = None, -1, 0, NO_ROWS

    def closed(whole: bool) -> dict:
        nonlocal held, piece, so_far
        # Of rows that must go together, two are adjacent to each other once, three twice.
        inside = sum(r.times - 1 for r in held)
        out = {"conv_id": key, "part": part, "conv": conv, "piece": piece, "whole": whole}
        out |= {"rows": [r._asdict() for r in held], "illegal": illegal([r.role for r in held]) + inside}
        if whole:
            out["edits"] = cheapest(held)[1]
        else:
            found = [cheapest(held, p, q) for p in STATES for q in STATES]
            so_far, back = so_far.then(Ways.of(found))
            out |= {"ways": [f and f[1] for f in found], "back": back, "costs": so_far.costs, "order": so_far.order}
        piece, held = piece + 1, []
        return out

    for row in rows:
        if conv < 0 or row["conv_id"] != key:
            if held:
                # The first conversation of a task may have begun in another.
                yield closed(whole=piece == 0 and conv > 0)
            key, conv, piece, so_far = row["conv_id"], conv + 1, 0, NO_ROWS
        stays = 0 if row["must_go"] else 1
        new = [Row(row["role"], row["text"], False, row["truncated"])] * stays
        if row["copies"] > stays:
            new.append(Row(row["role"], row["text"], True, False, row["copies"] - stays))
        for one in new:
            if len(held) == most:
                yield closed(whole=False)
            held.append(one)
    if held:
        # The last one may go on in another task.
        yield closed(whole=False)


def choose(parts: pa.Table) -> pa.Table:
    """Entry and exit of each part of one conversation, and what is inserted after the last."""
    rows = sorted(parts.to_pylist(), key=lambda r: (r["part"], r["conv"]))
    so_far, chain = NO_ROWS, []
    for row in rows:
        so_far, back = so_far.then(Ways(row["costs"], row["order"]))
        chain.append(back)
    ends = [(so_far.costs[q] + INSERT * len(TAIL[q]), so_far.order[q], q) for q in STATES if so_far.costs[q] >= 0]
    state, out = min(ends)[2], []
    for row, back in zip(reversed(rows), reversed(chain)):
        tail = TAIL[state] if not out else ""
        out.append({"part": row["part"], "conv": row["conv"], "entry": back[state], "exit": state, "tail": tail})
        state = back[state]
    numbers = [(name, pa.int32()) for name in ("part", "conv", "entry", "exit")]
    return pa.Table.from_pylist(out, pa.schema([*numbers, ("tail", pa.string())]))


def walked(rows: Iterator[dict]) -> Iterator[dict]:
    """Pieces with their edits; ``rows`` are the pieces of each part from the last to the first."""
    for _, part in groupby(rows, key=lambda r: (r["part"], r["conv"])):
        state = None
        for row in part:
            last = state is None
            state = row["exit"] if last else state
            before = row["back"][4 * row["entry"] + state]
            edits = row["ways"][4 * before + state] + (row["tail"] if last else "")
            state = before
            yield row | {"edits": edits, "entered": before}


def edited(found: DataFrame) -> DataFrame:
    """Pieces with their edits and what these make of them.

    ``conv_id, part, conv, piece, whole, cost, edits, illegal, first, last, repaired``:
    a conversation's pieces in order are its repaired rows.
    """
    rest = "part int, conv int, piece int, whole boolean, cost bigint, edits string, illegal bigint, first string"
    schema = _schema(
        found.schema["conv_id"].dataType, rest + ", last string, repaired array<struct<role: string, text: string>>"
    )

    def result(row: dict) -> dict:
        rows = [Row(**r) for r in row["rows"]]
        cost, made = carried_out(rows, row["edits"], row.get("entered", START))
        kept = {k: row[k] for k in ("conv_id", "part", "conv", "piece", "whole", "edits", "illegal")}
        ends = {"first": rows[0].role[:1], "last": rows[-1].role[:1]}
        return kept | ends | {"cost": cost, "repaired": [{"role": r, "text": t} for r, t in made]}

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(map(result, _rows(batches)), schema)

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(map(result, walked(_rows(batches))), schema)

    open_pieces = found.where(~F.col("whole"))
    parts = open_pieces.groupBy("conv_id", "part", "conv").agg(
        F.max_by("costs", "piece").alias("costs"), F.max_by("order", "piece").alias("order")
    )
    # A row per task that has rows of the conversation.
    chosen = parts.groupBy("conv_id").applyInArrow(choose, "part int, conv int, entry int, exit int, tail string")
    reversed_parts = (
        open_pieces.join(chosen, ["part", "conv"])
        .repartition("part", "conv")
        .sortWithinPartitions("part", "conv", F.desc("piece"))
    )
    return found.where("whole").mapInArrow(at_once, schema).unionByName(reversed_parts.mapInArrow(backwards, schema))


def fold(made: DataFrame) -> DataFrame:
    """``conv_id, illegal, cost, audit, repaired_sha256`` of each conversation.

    Those of one piece are digested by Spark's own functions. Of others, the pieces pass one
    task in order, a batch at a time, as the digest can't be made of parts.
    """
    schema = _schema(made.schema["conv_id"].dataType, "illegal bigint, cost bigint, audit string, repaired_sha256 string")

    def folded(rows: Iterator[dict]) -> Iterator[dict]:
        for key, own in groupby(rows, key=lambda r: r["conv_id"]):
            digest, out, audit, before, begun = hashlib.sha256(), {"illegal": 0, "cost": 0}, [], None, False
            for row in own:
                between = before is not None and before + row["first"] not in ("su", "ua", "au")
                out["illegal"] += row["illegal"] + between
                out["cost"] += row["cost"]
                audit.append(row["edits"])
                before = row["last"]
                for line in row["repaired"]:
                    digest.update(f"{chr(10) if begun else ''}{line['role']}:{line['text']}".encode())
                    begun = True
            yield out | {"conv_id": key, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(folded(_rows(batches)), schema)

    text = F.array_join(F.transform("repaired", lambda r: F.concat(r.role, F.lit(":"), r.text)), "\n")
    whole = made.where("whole").select(
        "conv_id", "illegal", "cost", F.col("edits").alias("audit"), F.sha2(text, 256).alias("repaired_sha256")
    )
    order = ["conv_id", "part", "conv", "piece"]
    rest = made.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions(*order)
    return whole.unionByName(rest.mapInArrow(run, schema))


def marked(conversations: DataFrame) -> DataFrame:
    """Distinct rows with their ``copies``, a ``digest`` of the text, and the first fault of each.

    ``blank, repeated, truncated, must_go``; ``repeated`` is of the first copy.
    """
    columns = ["conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]]
    counted = conversations.select(*columns).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = materialize(counted.withColumn("digest", F.sha2("text", 256)))
    place = F.struct(F.col("turn").isNotNull(), "turn")
    # Texts that a conversation has in several turns, with the first of these.
    again = (
        rows.groupBy("conv_id", "role", "digest")
        .agg(F.min(place).alias("_first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "_first")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "role", "digest")]
    blank = ~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    repeated = ~blank & F.coalesce(place > F.col("_first"), F.lit(False))
    truncated = ~blank & ~repeated & ~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    return (
        rows.join(again, same, "left")
        .select(*rows.columns, blank.alias("blank"), repeated.alias("repeated"), truncated.alias("truncated"))
        .withColumn("must_go", F.col("blank") | F.col("repeated"))
    )


def repair(rows: DataFrame, most: int = PIECE) -> DataFrame:
    """The conversations of ``marked`` rows, repaired, in pieces; see ``edited``."""
    return edited(materialize(pieces(rows, most)))


def findings(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated`` of the conversations of ``marked`` rows."""
    n = F.col("copies")
    # Copies of a row that is not blank repeat it.
    repeats = F.when(F.col("blank"), 0).when(F.col("repeated"), n).otherwise(n - 1)
    # In two steps, so that turns are told apart before the rows of a conversation meet.
    turns = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(repeats).alias("duplicate"),
        F.sum(F.col("truncated").cast("bigint")).alias("truncated"),
    )
    gaps = F.max("turn").cast("bigint") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults: some are dropped, emptied, cut short, repeated or given to the user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    role = F.when(kind == 4, "user").otherwise(text_of("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies))
    ).drop("col")


def audit(given: DataFrame, conversations: DataFrame, most: int = PIECE) -> DataFrame:
    """What was found in ``conversations`` and done about it, for each ``conv_id`` of ``given``."""
    rows = marked(conversations)
    out = given.select("conv_id").distinct()
    for part in (findings(rows), fold(repair(rows, most))):
        named = part.withColumnRenamed("conv_id", "_id")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def op11_deepening_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return audit(given, damaged(given))


#: Row by row, the best edits up to each state; the checksum is made bit by bit.
SQL = r"""
with recursive given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(
      list_prepend(4294967295::ubigint, list_transform(
        string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
        lambda c: unicode(c)::ubigint)),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]),
        lambda v, bit: xor(v // 2, (v % 2) * 3988292384::ubigint))), 4294967295::ubigint) % 20 as kind
  from conversations),
rows as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from given, (select unnest([1, 2]) as copy) where kind <> 0 and (copy = 1 or kind = 3)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as place,
    left(role, 1) as initial, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank from rows),
judged as (
  select *, not blank and row_number() over (partition by conv_id, role, text order by place) > 1 as duplicate,
    lag(initial) over (partition by conv_id order by place) || initial as pair from placed),
faults as (
  select *, not blank and not duplicate and not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as truncated,
    count(*) over (partition by conv_id) as n from judged),
due as (select * from (values (0, 2), (1, 2), (2, 3), (3, 2)) t(state, next)),
inserts as (
  select state, 0 as n, state as next, '' as edits, '' as lines from due
  union all select state, 1, next, 'I', case next when 2 then 'user:' else 'assistant:' end || chr(10) from due
  union all select a.state, 2, b.next, 'II', case a.next when 2 then 'user:' else 'assistant:' end || chr(10)
    || case b.next when 2 then 'user:' else 'assistant:' end || chr(10) from due a join due b on b.state = a.next),
ways as (
  select conv_id, 0::bigint as place, 0 as state, 0::bigint as cost, '' as edits, '' as lines
  from (select distinct conv_id from rows)
  union all
  select conv_id, place, state, cost, edits, lines from (
    select w.conv_id, f.place, e.state,
      w.cost + 3 * i.n + e.cost as cost, w.edits || i.edits || e.edit as edits, w.lines || i.lines || e.line as lines
    from ways w join faults f on f.conv_id is not distinct from w.conv_id and f.place = w.place + 1
    join inserts i on i.state = w.state join due d on d.state = i.next,
    lateral (
      select 'D' as edit, 4 as cost, i.next as state, '' as line
      union all
      select 'K', 3 * f.truncated::int, case f.initial when 's' then 1 else d.next end, f.role || ':' || f.text || chr(10)
      where not f.blank and not f.duplicate
        and (f.initial = 's' and i.next = 0 or f.initial = case d.next when 2 then 'u' else 'a' end)
      union all
      select 'R', 3 + 3 * f.truncated::int, d.next,
        case d.next when 2 then 'user:' else 'assistant:' end || f.text || chr(10)
      where not f.blank and not f.duplicate) e)
  qualify row_number() over (partition by conv_id, place, state order by cost, edits) = 1),
ended as (
  select w.conv_id, w.cost + 3 * i.n as cost, w.edits || i.edits as audit, w.lines || i.lines as lines
  from ways w join (select conv_id, count(*) as n from rows group by conv_id) s
    on s.conv_id is not distinct from w.conv_id and s.n = w.place
  join inserts i on i.state = w.state and i.next in (0, 3)
  qualify row_number() over (partition by w.conv_id order by w.cost + 3 * i.n, w.edits || i.edits) = 1),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
    count(*) filter (truncated) as truncated,
    count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id)
select g.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
  coalesce(audit, '') as audit, sha256(coalesce(left(lines, -1), '')) as repaired_sha256
from (select distinct conv_id from conversations) g
left join counted c on c.conv_id is not distinct from g.conv_id
left join ended e on e.conv_id is not distinct from g.conv_id
"""

QUERIES = {"op11_deepening_repair": (op11_deepening_repair, SQL)}
