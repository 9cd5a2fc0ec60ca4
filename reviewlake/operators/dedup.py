"""Duplicates, unions and row limits, all with an explicit order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import text
from ..schema import ORDER_COLS
from ..scratch import materialize

#: A group of more rows is cut by thresholds before it is ranked.
LARGE = 100_000
#: Rows of a group that thresholds are told by.
SAMPLE = 10_000


def with_fingerprint(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "fp", text.fingerprint(F.col("review_id"), F.col("author"), F.col("body"))
    )


def first_per(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key."""
    # row_number() <= 1 is cut per map task first, so a key that holds many
    # rows sends one row per task through the shuffle.
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_by_fingerprint(
    df: DataFrame, order: Sequence[str] = ORDER_COLS, scope: Sequence[str] = ("company",)
) -> DataFrame:
    """First row per fingerprint within a company."""
    return first_per(with_fingerprint(df), [*scope, "fp"], order).drop("fp")


def dedup_by_id(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row per review id, across companies."""
    return first_per(df, ["review_id"], order)


def dedup_last(df: DataFrame, key: str = "company_or_url", order: str = "ord") -> DataFrame:
    """Last row per key (case and outer white space aside), at the first one's place."""
    values = [c for c in df.columns if c != order]
    return (
        df.groupBy(F.lower(text.strip(F.col(key))).alias("_key"))
        .agg(
            F.max_by(F.struct(*values), F.col(order)).alias("_last"),
            F.min(order).alias(order),
        )
        .select(*[F.col("_last")[c].alias(c) for c in values], order)
        .orderBy(order)
    )


def union_outer(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def cap_per_company(
    df: DataFrame,
    n: int,
    order: Sequence[str] = ORDER_COLS,
    by: Sequence[str] = ("company",),
) -> DataFrame:
    """First ``n`` rows per company."""
    return _first_rows(df, n, list(order), list(by))


def head(df: DataFrame, n: int, order: Sequence[str] = ORDER_COLS) -> DataFrame:
    """First ``n`` rows of the table."""
    return _first_rows(df, n, list(order), [])


def _first_rows(df: DataFrame, n: int, order: list[str], by: list[str]) -> DataFrame:
    """The first ``n`` rows of each group, in the order of columns that tell its rows apart.

    A limit that the optimizer cuts within each task, before anything is shuffled, is
    left to it. For others see ``select_first``.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return select_first(df, n, order, by) if by else select_head(df, n, order)
    if not by:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind, strict=True)])
    return F.lit(value).cast(kind)


def _at(df: DataFrame, numbers: DataFrame, by: list[str]) -> DataFrame:
    """``df`` with the columns of ``numbers``, which has a row per group."""
    named = numbers.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return df.join(named, same, "left").drop(*[f"_by_{c}" for c in by])


def _share(seed: int, order: list[str]) -> Column:
    """A number between 0 and 1, told by the order columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *order), F.lit(1 << 30)) / float(1 << 30)


def _ranked(rows: DataFrame, want: Column, order: list[str], by: list[str]) -> DataFrame:
    """The first ``want`` rows of each group; rows equal in all columns are counted first."""
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    ordered = Window.partitionBy(*by).orderBy(*order)
    before = F.sum("_copies").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    copies = F.least(F.col("_copies"), want - F.coalesce(before, F.lit(0)))
    last = alike.withColumn("_n", copies).where(F.col("_n") > 0)
    return last.select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")).drop("_i")


def select_head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows of the table, by thresholds; see ``select_first``."""
    key, kind = F.struct(*order), df.select(F.struct(*order).alias("k")).schema["k"].dataType
    taken, rest, size, before, seed = [], df, df.count(), float("inf"), 0
    while size > max(LARGE, n) and size < 0.9 * before:
        seed, before = seed + 1, size
        # Some SAMPLE keys, whatever the size.
        seen = rest.select(*order).where(_share(seed, order) < SAMPLE / size).select(key.alias("k"))
        keys = [r.k for r in seen.orderBy("k").collect()]
        place = len(keys) * n / size
        slack = 5 * place**0.5 + 10
        low = _literal(keys[int(place - slack) - 1] if place - slack >= 1 else None, kind)
        high = _literal(keys[int(place + slack)] if place + slack < len(keys) else None, kind)
        under, upto = rest.select(*order).agg(F.count_if(key <= low), F.count_if(key <= high)).first()
        if upto >= n:
            rest, size = rest.where(key <= high), upto
        if under <= n:
            taken.append(rest.where(key <= low))
            rest, size, n = rest.where(F.coalesce(key > low, F.lit(True))), size - under, n - under
    last = rest if size <= n else _ranked(rest, F.lit(n), order, [])
    return reduce(DataFrame.unionByName, [*taken, last])


def select_first(df: DataFrame, n: int, order: list[str], by: list[str]) -> DataFrame:
    """The first ``n`` rows of each group, by thresholds.

    A sample of each large group tells two places in its order, between which its ``n``-th
    row almost surely lies. One scan counts the rows up to both. Rows up to the lower one
    are taken as they are, those beyond the upper one are left; the few in between go on
    in the same way, until none of the groups is large, and only then rows are shuffled and
    ranked. A place that the counts show to be wrong is not used. So what is moved does not
    grow with ``n`` or the table, and no group is gathered in one task. ``df`` is scanned
    twice a round, its order and group columns alone.

    Rows equal in all columns are counted before they are ranked.
    """
    key = F.struct(*order)
    narrow = list(dict.fromkeys([*by, *order]))
    # What is left of each group, and how many of its rows are still to be taken.
    taken, rest, seed = [], df, 0
    sizes = materialize(df.groupBy(*by).agg(F.count("*").alias("_size")).withColumn("_want", F.lit(n).cast("bigint")))
    large = (F.col("_size") > LARGE) & (F.col("_size") > F.col("_want"))
    while not (groups := sizes.where(large)).isEmpty():
        seed += 1
        sized = _at(rest.select(*narrow), groups, by)
        seen = sized.where(_share(seed, order) < SAMPLE / F.col("_size")).select(*by, key.alias("_key"), "_size", "_want")
        whole = Window.partitionBy(*by)
        # The place of the n-th row in the sample, give or take what chance may do.
        place = F.count("*").over(whole) * F.col("_want") / F.col("_size")
        slack = 5 * F.sqrt(place) + 10
        ranked = seen.withColumns({"_k": F.row_number().over(whole.orderBy("_key")), "_place": place, "_slack": slack})
        cuts = materialize(
            ranked.groupBy(*by).agg(
                F.max(F.when(F.col("_k") <= F.col("_place") - F.col("_slack"), F.col("_key"))).alias("_low"),
                F.min(F.when(F.col("_k") >= F.col("_place") + F.col("_slack"), F.col("_key"))).alias("_high"),
            )
        )
        counted = (
            _at(rest.select(*narrow), cuts, by)
            .where(F.col("_low").isNotNull() | F.col("_high").isNotNull())
            .groupBy(*by)
            .agg(
                F.count_if(key <= F.col("_low")).alias("_under"),
                F.count_if(key <= F.col("_high")).alias("_upto"),
                F.max("_low").alias("_low"),
                F.max("_high").alias("_high"),
            )
        )
        under, upto = F.col("_under") <= F.col("_want"), F.col("_upto") >= F.col("_want")
        checked = _at(sizes, counted, by).withColumns(
            {
                "_before": F.col("_size"),
                "_low": F.when(under, F.col("_low")),
                "_high": F.when(upto, F.col("_high")),
                "_under": F.when(under & F.col("_low").isNotNull(), F.col("_under")).otherwise(0),
                "_upto": F.when(upto & F.col("_high").isNotNull(), F.col("_upto")).otherwise(F.col("_size")),
            }
        )
        left = {"_size": F.col("_upto") - F.col("_under"), "_want": F.col("_want") - F.col("_under")}
        known = materialize(checked.withColumns(left).select(*by, "_size", "_want", "_before", "_low", "_high"))
        placed = _at(rest, known.select(*by, "_low", "_high"), by)
        taken.append(placed.where(key <= F.col("_low")).select(*df.columns))
        above = F.coalesce(key > F.col("_low"), F.lit(True)) & F.coalesce(key <= F.col("_high"), F.lit(True))
        rest = placed.where(above).select(*df.columns)
        sizes = known.select(*by, "_size", "_want", "_before")
        # Equal rows are not told apart by any threshold.
        large = (F.col("_size") > LARGE) & (F.col("_size") > F.col("_want")) & (F.col("_size") < 0.9 * F.col("_before"))
    wanted = _at(rest, sizes.select(*by, "_size", "_want"), by)
    taken.append(wanted.where("_size <= _want").select(*df.columns))
    last = _ranked(wanted.where("_size > _want").drop("_size"), F.col("_want"), order, by)
    return reduce(DataFrame.unionByName, [*taken, last.select(*df.columns)])


def limit_pages(df: DataFrame, max_pages: int) -> DataFrame:
    """The first ``max_pages`` pages of each company; none if that is not positive."""
    return df.where(F.col("page_seq") < max_pages)
