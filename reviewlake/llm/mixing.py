"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. Each source has a weight schedule, a polyline of
``(time, weight)`` knots. The integral of a schedule is the source's share of all
words; its running integral is the source's cumulative demand. A source lays its
documents out one after the other, in an order given by a digest, again and again;
the word at offset ``x`` is due when the cumulative demand reaches ``x``. Inverting
the demand gives each copy of a document its training position, and a range sort by
position gives the training order.

Sources are taken by code point, null last, and get the schedules in turn. The words
wanted are ``share`` times all words. A source's target stops at ``max_repeats`` times
its size, and the excess goes to the others by weight.

A hot source is never one task: its documents are spread over ``BUCKETS`` ranges of the
digest, the ranges' sums give each range its offset, and only within a range do the
documents stand in one task. Only the table with a row per source goes through one task.

Defined results: a null text has no words and is not taken; a document of a null source
belongs to the null source; repeated rows are documents of their own; an empty table
gives an empty result; input columns named as a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..scratch import materialize
from .common import SPACES, n_words, table, with_only

Schedule = Sequence[tuple[float, float]]

#: Integrals 3, 1 and 2: a source that leaves, one that stays, one that comes.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 4.5), (1.0, 1.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (1.0, 3.0)),
)
#: Ranges of the digest per source: 4096, by three hexadecimal digits.
DIGITS = 3


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """Start, length, weight at the start, slope and integral before, of each piece."""
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        if t1 <= t0 or w0 < 0 or w1 < 0:
            raise ValueError("a schedule's times rise and its weights are not negative")
        out.append((t0, t1 - t0, w0, (w1 - w0) / (t1 - t0), before))
        before += (w0 + w1) / 2 * (t1 - t0)
    if before <= 0:
        raise ValueError("a schedule needs a positive integral")
    return out


def integral(schedule: Schedule) -> float:
    return sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def due(schedule: Schedule, part: Column) -> Column:
    """The time at which the demand has reached ``part`` (0 to 1) of its whole."""
    area = part * F.lit(integral(schedule))
    pieces = segments(schedule)
    out = None
    for (t0, length, w0, slope, before), following in zip(pieces, [*pieces[1:], None], strict=True):
        rest = F.greatest(area - F.lit(before), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + rest * F.lit(2.0 * slope), F.lit(0.0)))
        at = F.when(rest == 0, F.lit(t0)).otherwise(
            F.least(F.lit(t0) + rest * F.lit(2.0) / (F.lit(w0) + root), F.lit(t0 + length))
        )
        if following:
            here = area < F.lit(following[4])
            out = F.when(here, at) if out is None else out.when(here, at)
        else:
            out = at if out is None else out.otherwise(at)
    return out


def copy_due(schedule: Schedule, copy: Column) -> Column:
    return due(schedule, copy["offset"] / F.col("target"))


def targets(sizes: DataFrame, schedules: Sequence[Schedule], share: float, max_repeats: float) -> DataFrame:
    """Target words of each row of ``_source, source, source_size``, one per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(integral(s)) for s in schedules]),
        ((F.row_number().over(by_name) - 1) % len(schedules) + 1).cast("int"),
    )
    # Sources reach their limits in the order of limit / weight. The level is the one
    # at which the first source that stays below its limit, and all after it, stand: the
    # highest of those that such a source would give.
    order = Window.orderBy("_full_at", "_source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(onward)
    return (
        sizes.withColumn("_weight", weight)
        .withColumn("_class", (F.row_number().over(by_name) - 1) % len(schedules))
        .withColumn("_limit", F.col("source_size") * F.lit(max_repeats))
        .withColumn("_full_at", F.col("_limit") / F.col("_weight"))
        .withColumn("_level", level)
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_full_at"), F.col("_level"))).over(whole))
        .withColumn("target", F.coalesce(F.least("_limit", F.col("_weight") * F.col("_level")), F.col("_limit")))
        .select("_source", "_class", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = 1.5,
    max_repeats: float = 2.0,
) -> DataFrame:
    """Each document with ``size, source_size, target, taken, copies``.

    ``copies`` has ``epoch, taken, position`` of each copy the mix takes, in order. The
    copy that stands at the target is cut there, so a source's taken words are its
    target, rounded.
    """
    own = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.lit("/"), F.coalesce(F.md5("text"), F.lit("~"))
    )
    placed = with_only(
        docs,
        size=n_words(F.col("text")),
        _source=F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")),
        _order=F.md5(own),
    ).withColumn("_bucket", F.substring("_order", 1, DIGITS))
    buckets = materialize(
        placed.groupBy("_source", "_bucket").agg(F.max("source").alias("source"), F.sum("size").alias("_words"))
    )
    sizes = buckets.groupBy("_source").agg(F.max("source").alias("source"), F.sum("_words").alias("source_size"))
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).join(
        targets(sizes, schedules, share, max_repeats), "_source"
    )
    ahead = (
        Window.partitionBy("_source", "_bucket")
        .orderBy("_order", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    goal = F.floor(F.col("target") + 0.5)
    copies = F.transform(
        F.sequence(F.lit(0), F.lit(math.ceil(max_repeats) - 1)),
        lambda epoch: F.struct(
            epoch.alias("epoch"),
            (F.col("_start") + epoch * F.col("source_size")).alias("offset"),
        ),
    )
    position = F.lit(None).cast("array<double>")
    for i, schedule in enumerate(schedules):
        times = F.transform("_copies", partial(copy_due, schedule))
        position = F.when(F.col("_class") == i, times).otherwise(position)
    joined = (
        placed.withColumn("_ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
        .join(offsets.drop("source", "_words"), ["_source", "_bucket"])
        .withColumn("_start", F.col("_before") + F.col("_ahead"))
        .withColumn("_copies", F.filter(copies, lambda c: (F.col("size") > 0) & (c["offset"] < goal)))
        .withColumn("_at", position)
    )
    taken = F.transform(
        F.arrays_zip("_copies", "_at"),
        lambda z: F.struct(
            z["_copies"]["epoch"].alias("epoch"),
            F.least(F.col("size"), goal - z["_copies"]["offset"]).alias("taken"),
            z["_at"].alias("position"),
        ),
    )
    kept = [c for c in docs.columns if c.lower() not in {"size", "source_size", "target", "taken", "copies"}]
    return (
        joined.withColumn("copies", taken)
        .withColumn("taken", F.aggregate("copies", F.lit(0).cast("bigint"), lambda n, c: n + c["taken"]))
        .select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", "taken", "copies")
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """The copies of ``mix``, range-sorted by position; a cut copy has its first words.

    ``mixed``'s columns, with ``epoch`` and ``position`` of the copy and its ``taken``.
    """
    copy = F.explode("copies").alias("_copy")
    kept = [c for c in mixed.columns if c.lower() not in {"copies", "epoch", "position", "taken"}]
    words = F.regexp_extract_all(F.col("text"), F.lit(rf"[{SPACES}]*[^{SPACES}]+"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("taken").cast("int")), "")
    rows = mixed.select(*[F.col(f"`{c}`") for c in kept], copy).select(
        *[F.col(f"`{c}`") for c in kept], F.col("_copy.*")
    )
    return rows.withColumn("text", F.when(F.col("taken") < F.col("size"), cut).otherwise(F.col("text"))).orderBy(
        "position", "doc_id", "epoch"
    )


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (
        mix(docs)
        .select("doc_id", "size", "source_size", "target", "taken", F.get("copies", F.lit(0))["position"].alias("first_position"))
        .orderBy("first_position", "doc_id")
    )


SQL = """
with placed as (
  select doc_id, source, coalesce('s' || source, 'n') as src,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size,
    md5(coalesce(cast(doc_id as varchar), '~') || '/' || coalesce(md5(text), '~')) as ord
  from documents),
sizes as (select src, max(source) as source, cast(sum(size) as double) as source_size from placed group by src),
ranked as (
  select *, (row_number() over (order by source nulls last) - 1) % 3 as class,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double
      else 2.0::double end as weight, source_size * 2.0::double as lim from sizes),
levels as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(lim) over (order by lim / weight, src
      rows between unbounded preceding and 1 preceding), 0)) /
    sum(weight) over (order by lim / weight, src rows between current row and unbounded following) as lev
  from ranked),
targets as (
  select src, class, source_size,
    coalesce(least(lim, weight * max(case when lev <= lim / weight then lev end) over ()), lim) as target
  from levels),
laid as (
  select p.*, t.class, t.source_size, t.target, floor(t.target + 0.5::double) as goal,
    coalesce(sum(size) over (partition by p.src order by ord, size rows between unbounded preceding and 1 preceding), 0)
      as start
  from placed p join targets t on p.src = t.src)
select doc_id, size::bigint as size, source_size::bigint as source_size, target,
  (case when size > 0 then least(size, greatest(goal - start, 0)) + least(size, greatest(goal - start - source_size, 0))
   else 0 end)::bigint as taken,
  case when size = 0 or start >= goal then null
    when start = 0 then 0.0::double
    when class = 0 then least(start / target * 3.0::double * 2.0::double
      / (4.5::double + sqrt(greatest(20.25::double + start / target * 3.0::double * -6.0::double, 0.0::double))), 1.0::double)
    when class = 1 then least(start / target * 2.0::double / (1.0::double + 1.0::double), 1.0::double)
    else least(start / target * 2.0::double * 2.0::double
      / (1.0::double + sqrt(greatest(1.0::double + start / target * 2.0::double * 4.0::double, 0.0::double))), 1.0::double)
  end as first_position
from laid
"""

QUERIES = {"op1_source_mix": (op1_source_mix, SQL)}
