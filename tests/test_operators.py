"""Filters, duplicates, limits, joins on hot keys: against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from reviewlake.scratch import materialize
from reviewlake.operators import dedup, filters, project, report
from reviewlake.plans.flow import clean_reviews
from reviewlake.schema import REVIEW_COLS
from reviewlake.sources.read import require_columns

ROWS = "company string, review_id string, author string, body string, ord long"


def sample(n=3000, seed=1):
    """Reviews of which a third share one company, one id and one text."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rnd.random() < 0.34:
            rows.append(("HOT", "1", "a", "same", i))
        else:
            rows.append(
                (
                    rnd.choice(["A", "B", "SAMPLE", None]),
                    rnd.choice([None, "", *map(str, range(200))]),
                    rnd.choice([None, "Ana", "ANA"]),
                    rnd.choice([None, "", "x", "X"]),
                    i,
                )
            )
    rnd.shuffle(rows)
    return rows


def first_per(rows, key):
    kept = {}
    for row in sorted(rows, key=lambda r: r[4]):
        kept.setdefault(key(row), row)
    return sorted(kept.values(), key=lambda r: r[4])


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[4])


@pytest.fixture(scope="module")
def rows():
    return sample()


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_dedup_whatever_the_partitions(spark, rows, partitions):
    df = spark.createDataFrame(rows, ROWS).repartition(partitions)

    def fp(r):
        return r[1] if r[1] else ((r[2] or "").lower(), (r[3] or "").lower()[:200])

    assert got(dedup.dedup_by_fingerprint(df, ["ord"])) == first_per(
        rows, lambda r: (r[0], bool(r[1]), fp(r))
    )
    assert got(dedup.dedup_by_id(df, ["ord"])) == first_per(rows, lambda r: r[1])


def test_clean_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    once = clean_reviews(df, ["ord"])
    kept = [r for r in rows if r[0] != "SAMPLE" and r[1] is not None]
    assert got(once) == first_per(kept, lambda r: r[1])
    assert got(clean_reviews(once, ["ord"])) == got(once)


def python_cap(rows, n):
    kept, seen = [], {}
    for row in sorted(rows, key=lambda r: r[4]):
        seen[row[0]] = seen.get(row[0], 0) + 1
        if seen[row[0]] <= n:
            kept.append(row)
    return kept


@pytest.mark.parametrize("n", [1, 3, 700, 5000])
def test_cap(spark, rows, n):
    df = spark.createDataFrame(rows, ROWS)
    assert got(dedup.cap_per_company(df, n, ["ord"])) == python_cap(rows, n)
    assert got(dedup.head(df, n, ["ord"])) == sorted(rows, key=lambda r: r[4])[:n]


@pytest.mark.parametrize("n", [3, 999, 1000, 1001, 50_000])
@pytest.mark.parametrize("order", [["name"], ["at"], ["sparse"], ["kind", "name"]])
def test_limits_are_a_plain_rank(spark, monkeypatch, n, order):
    """Text, integer, sparse and mixed orders, a hot company and a company without name."""
    monkeypatch.setattr(dedup, "LARGE", 5_000)
    monkeypatch.setattr(dedup, "SAMPLE", 1_000)
    rows = spark.range(60_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('c', id % 50) end as company",
        "sha1(cast(id as string)) as name",
        "id as at",
        "xxhash64(id) as sparse",
        "id % 4 as kind",
    )
    ranked = "row_number() over (partition by company order by {0})".format(", ".join(order))
    expected = rows.selectExpr("*", f"{ranked} as rn").where(f"rn <= {n}").drop("rn")
    capped = dedup.cap_per_company(rows, n, order)
    assert capped.count() == expected.count() and capped.exceptAll(expected).isEmpty()
    first = dedup.head(rows, n, order)
    top = rows.orderBy(*order).limit(n)
    assert first.count() == n and first.exceptAll(top).isEmpty()


def test_cap_with_several_order_columns(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), p, s, i) for p in range(9) for s in range(2) for i in range(40)]
    df = spark.createDataFrame(rows, "company string, page_seq int, source_rank int, pos long")
    expected = {}
    for r in sorted(rows, key=lambda r: r[1:]):
        expected.setdefault(r[0], []).append(r)
    expected = sorted(r for rs in expected.values() for r in rs[:123])
    assert sorted(map(tuple, dedup.cap_per_company(df, 123).collect())) == expected


@pytest.mark.parametrize("limit", [dedup.cap_per_company, dedup.head])
def test_limits_below_one(spark, rows, limit):
    with pytest.raises(ValueError):
        limit(spark.createDataFrame(rows, ROWS), 0)


def test_limit_pages(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "page_seq int")
    assert dedup.limit_pages(df, 2).count() == 2
    assert dedup.limit_pages(df, 0).count() == 0


def test_union_keeps_first_seen_order(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    union = dedup.union_outer([a, b])
    assert union.columns == ["x", "y", "z"]
    assert sorted(map(tuple, union.collect()), key=str) == [(1, 2, None), (4, None, 3)]


def test_dedup_last(spark):
    rows = [("x.es", 1, 0), ("B", 2, 1), (" X.ES ", 3, 2), ("b", 4, 3)]
    df = spark.createDataFrame(rows, "company_or_url string, v int, ord long")
    assert [tuple(r) for r in dedup.dedup_last(df).collect()] == [(" X.ES ", 3, 0), ("b", 4, 1)]


def test_prune_empty(spark):
    rows = [
        (None, "", 0.0, None, ""),
        (None, None, None, None, None),
        ("t", None, None, None, None),
        (None, None, float("nan"), None, None),
        (None, None, 0.0, None, "2024"),
    ]
    df = spark.createDataFrame(
        rows, "title string, body string, rating double, author string, date_published string"
    )
    assert filters.prune_empty(df).count() == 3


def test_drop_sample_keeps_rows_without_company(spark):
    df = spark.createDataFrame([("SAMPLE",), ("sample",), (None,)], "company string")
    assert sorted(map(str, filters.drop_sample(df).collect())) == [
        "Row(company='sample')",
        "Row(company=None)",
    ]


def test_drop_blank_text(spark):
    df = spark.createDataFrame([("\xa0 ",), (None,), ("a",)], "body string")
    assert filters.drop_blank_text(df).count() == 1


def test_explore(spark):
    df = spark.createDataFrame(
        [("A", "P", "g", "s"), ("A", "N", "g", "s"), ("B", "P", "g", "t")],
        "company string, sentiment_label string, general_category string, specific_category string",
    )
    assert filters.explore(df).count() == 3
    assert filters.explore(df, company="A", sentiment="P").count() == 1
    assert filters.explore(df, general="g", specific="s").count() == 2


def test_pick_column():
    assert project.pick_column([" URL ", "Url"], ["link", "url"]) == "Url"
    assert project.pick_column(["a"], ["b"]) is None


def test_timestamps_keep_the_wall_clock(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00+02:00' as t, 1 as x")
    naive = project.make_timestamps_naive(df)
    assert dict(naive.dtypes) == {"t": "timestamp_ntz", "x": "int"}
    assert str(naive.first().t) == "2023-12-31 22:00:00"


def test_to_review(spark):
    df = spark.createDataFrame(
        [["u"] * 4 + ["4.5", "a", "b", "c", "d"]],
        ["source_url", "location", "date_published", "author", "rating", "body", "title", "review_id", "x"],
    )
    reviews = project.to_review(df)
    assert reviews.columns == REVIEW_COLS
    assert reviews.first().rating == 4.5


def test_require_columns(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"]) is df
    with pytest.raises(KeyError, match="body"):
        require_columns(df, ["id", "body"])


def test_profile_counts_rows_that_share_a_fingerprint(spark):
    df = spark.createDataFrame(
        [("A", None, None, ""), ("A", None, None, None), ("A", "1", None, None), ("A", "1", "x", "y")],
        "company string, review_id string, author string, body string",
    )
    assert tuple(report.profile(df).first()) == ("A", 4, 2, 1, 1, 2)


def test_matrix_without_labels_is_zero(spark):
    df = spark.createDataFrame([("A", None), ("A", "Positiva")], "company string, sentiment_label string")
    assert tuple(report.company_by_sentiment(df).first()) == ("A", 1, 0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_are_cut_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    for cut in (
        dedup.dedup_by_id(df, ["ord"]),
        dedup.dedup_by_fingerprint(df, ["ord"]),
        dedup.cap_per_company(df, 3, ["ord"]),
    ):
        assert "WindowGroupLimit" in plan(cut) and "Partial" in plan(cut)
    assert "TakeOrderedAndProject" in plan(dedup.head(df, 3, ["ord"]))


def _shuffled(df):
    """Rows that the plan's exchanges wrote."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    node, counts = [df._jdf.queryExecution().executedPlan()], []
    while node:
        p = node.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            node.append(p.executedPlan())
            continue
        if "QueryStage" in p.nodeName():
            node.append(p.plan())
        if p.nodeName() == "Exchange":
            counts.append(p.metrics().apply("shuffleRecordsWritten").value())
        children = p.children()
        node += [children.apply(i) for i in range(children.size())]
    return sum(counts)


@pytest.mark.parametrize("by", [[], ["company"]])
def test_large_limits_move_few_rows(spark, monkeypatch, by):
    monkeypatch.setattr(dedup, "LARGE", 20_000)
    rows = spark.range(400_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('c', id % 50) end as company",
        "sha1(cast(id as string)) as name", "id % 7 as kind", "id",
    )
    n = 30_000
    first = dedup._first_rows(materialize(rows), n, ["kind", "name"], by)
    assert _shuffled(first) < 60_000
    rank = f"row_number() over ({'partition by company' if by else ''} order by kind, name)"
    expected = rows.selectExpr("*", f"{rank} as rn").where(f"rn <= {n}").drop("rn")
    assert first.count() == expected.count() and first.exceptAll(expected).isEmpty()


def test_limits_among_equal_rows(spark, monkeypatch):
    """A third of all rows are one row, and all of a group's rows are in one place of the order."""
    monkeypatch.setattr(dedup, "LARGE", 500)
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', 'cold') as company", "if(id % 3 = 0, -1, id % 90) as ord")
    rows = materialize(rows)
    for n in (1200, 9_999, 10_001):
        got = {tuple(r) for r in dedup.cap_per_company(rows, n, ["ord"]).groupBy("company").count().collect()}
        assert got == {("hot", min(n, 10_000)), ("cold", n)}
        kept = dedup.head(rows, n, ["ord"]).groupBy("ord").count().orderBy("ord").collect()
        assert kept[0]["count"] == min(n, 10_000) and sum(r["count"] for r in kept) == n
