"""Files, tables, streams and the whole flow."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from catalog.inputs import harvest_list, site_pages
from reviewlake.operators import filters
from reviewlake.plans.flow import harvest, run
from reviewlake.schema import CLASSIFIED_COLS, warehouse_schema
from reviewlake.scratch import materialize, scratch_dir
from reviewlake.sources import companies, read, write
from reviewlake.streaming import reviews as streams
from test_classify import shout

SF_DIR = "/root/testdata/sf0.001"
HEADER = "review_id,title,body,rating,author,date_published,location,source_url\n"


@pytest.fixture
def folder(tmp_path):
    def put(name, content, encoding="utf-8"):
        (tmp_path / name).write_bytes(content.encode(encoding))

    put("trustpilot_reviews_dhl españa.csv", HEADER + '7,"dijo ""hola"", y","uno\ndos",4.0,,,,u\n', "utf-8-sig")
    put("trustpilot_reviews_x+y.csv", "body,review_id,extra\nb,007,\n,NA,e\n")
    put("trustpilot_reviews_sample.csv", HEADER + "1,,,,,,,\n")
    put("trustpilot_reviews_empty.csv", "")
    put("other.CSV", HEADER + "9,,,,,,,\n")
    os.mkdir(tmp_path / "sub")
    put("sub/inner.csv", HEADER + "8,,,,,,,\n")
    return str(tmp_path)


def test_review_folder(spark, folder):
    df = read.read_review_folder(spark, folder)
    assert set(df.columns) == {*HEADER.strip().split(","), "extra", "company", "row"}
    rows = {r.review_id: r for r in df.collect()}
    assert set(rows) == {"7", "007", "NA", "1"}
    assert rows["7"].title == 'dijo "hola", y' and rows["7"].body == "uno\ndos"
    assert rows["7"].company == "DHL ESPAÑA" and rows["7"].author is None
    assert rows["007"].company == "X+Y" and rows["007"].title is None and rows["007"].extra is None
    assert rows["007"].row < rows["NA"].row
    assert rows["1"].company == "SAMPLE"


def test_one_file_of_inner_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    """Records, some of them longer than a block, cut anywhere, as one reader reads them."""
    rnd = random.Random(3)
    bits = ["a", '""', "\n", "\r\n", ",", "é", " ", "\n\n", '"",""', "x" * 50]
    bodies = ["".join(rnd.choices(bits, k=rnd.randrange(0, 30))) for _ in range(1500)]
    bodies[700] = '\n"",""'.join(["y" * 40] * 300)
    lines = [f'{i},t{i},"{b}",4.0,"A ""B"" C",,,u{rnd.choice([chr(13), ""])}\n' for i, b in enumerate(bodies)]
    lines[5] += "\n"
    (tmp_path / "trustpilot_reviews_x.csv").write_bytes((HEADER + "".join(lines)).encode())
    whole = {r.review_id: r for r in read._csv(spark, HEADER.strip().split(","), True).csv(str(tmp_path)).collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)
    spark.conf.set("spark.sql.files.openCostInBytes", 100)
    try:
        lines = read._lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 50 and read._blocks(lines).where("inside").count() > 10
        rows = sorted(read.read_review_folder(spark, str(tmp_path)).collect(), key=lambda r: r.row)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.review_id for r in rows] == [str(i) for i in range(1500)]
    for r in rows:
        one = whole[r.review_id]
        assert (r.title, r.body, r.author, r.company) == (one.title, one.body, one.author, "X")
        assert (r.source_url or "").rstrip() == (one.source_url or "").rstrip() == "u"


def test_quotes_that_do_not_pair_up(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '1,5" wide,b,,,,,u\n2,t,"x\ny",,,,,u\n')
    (tmp_path / "b.csv").write_text(HEADER + '3,t,"x\ny",,,,,u\n')
    rows = {r.review_id: (r.title, r.body) for r in read.read_review_folder(spark, str(tmp_path)).collect()}
    assert rows == {"1": ('5" wide', "b"), "2": ("t", "x\ny"), "3": ("t", "x\ny")}


def test_folder_of_many_files_of_one_layout(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"trustpilot_reviews_c{i}.csv").write_text(HEADER + f"{i},t,,,,,,u\n")
    rows = read.read_review_folder(spark, str(tmp_path)).collect()
    assert {(r.review_id, r.company) for r in rows} == {(str(i), f"C{i}") for i in range(300)}


def test_replaced_table_with_a_path_is_empty(spark):
    path = scratch_dir(spark)
    name = "emptied_" + path.rsplit("-", 1)[1]
    df = spark.range(5)
    write.load_table(df, name, path)
    write.create_table_like(df, name, replace=True, path=path)
    assert read.read_table(spark, name).count() == 0
    write.write_table(df.limit(2), name, "append", path)
    assert read.read_table(spark, name).count() == 2


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    from pyspark import SparkContext

    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("the session has a shared folder")
    monkeypatch.setattr(SparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(SparkContext, "getCheckpointDir", lambda self: None)
    with pytest.raises(ValueError):
        scratch_dir(spark)


def test_folder_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read.read_review_folder(spark, str(tmp_path))


def test_combined(spark, tmp_path):
    rows = [("1", 'a "b"\nc', 4.5, "DHL"), ("2", None, None, "X")]
    df = spark.createDataFrame(rows, "review_id string, body string, rating double, company string")
    for fmt in ("csv", "parquet"):
        write.write_combined(df, str(tmp_path / fmt), fmt)
        back = read.read_combined(spark, str(tmp_path / fmt), fmt)
        assert sorted((r.review_id, r.body, r.company) for r in back.collect()) == [
            ("1", 'a "b"\nc', "DHL"),
            ("2", None, "X"),
        ]
        with pytest.raises(FileNotFoundError):
            read.read_combined(spark, str(tmp_path / "none"), fmt)


def specs(spark, header, rows, **kwargs):
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header)).coalesce(1)
    return [tuple(r)[:2] for r in companies.company_specs(df, **kwargs).collect()]


@pytest.mark.parametrize(
    "header, rows, expected",
    [
        ([" EMPRESA ", "Url"], [("a", None), (" b ", " http://x "), (" ", None)], [("a", "a"), ("b", "http://x")]),
        (["link"], [("u",)], [("u", "u")]),
        (["foo", "bar"], [("a", "b")], [("a", "a")]),
        (["name"], [("X.es",), ("y",), ("x.ES ",)], [("x.ES", "x.ES"), ("y", "y")]),
        (["domain", "company"], [("d", "c")], [("c", "c")]),
        (["página", "enlace", "nombre"], [("p", "e", None)], [("e", "e")]),
    ],
)
def test_company_list(spark, header, rows, expected):
    assert specs(spark, header, rows) == expected


def test_company_list_with_named_columns(spark):
    assert specs(spark, ["a", "b"], [("1", "2")], company_col="b", url_col="a") == [("2", "1")]


def test_company_csv(spark, tmp_path):
    rows = [("1", "a,b", 'di "x"\n y ', 4.0, None, "", None, "u", "s", i) for i in range(5)]
    schema = "review_id string, title string, body string, rating double, author string, date_published string, location string, source_url string, slug string, pos int"
    write.write_company_csv(spark.createDataFrame(rows, schema), str(tmp_path / "out"))
    (part,) = (tmp_path / "out" / "slug=s").glob("*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == HEADER.strip()
    assert lines[1:3] == ['1,"a,b","di ""x""', ' y ",4.0,,,,u']
    back = read.read_company_csv(spark, str(tmp_path / "out"))
    assert {(r.body, r.rating, r.date_published, r.company) for r in back.collect()} == {
        ('di "x"\n y ', 4.0, None, "S")
    }


def test_filters_reach_the_files(spark, tmp_path):
    rows = [("1", "A", "Positiva", "s"), ("2", "B", "Negativa", "t")]
    df = spark.createDataFrame(rows, "review_id string, company string, sentiment_label string, slug string")
    write.write_classified(df, str(tmp_path / "p"), "parquet")
    seen = filters.explore(spark.read.parquet(str(tmp_path / "p")), company="A", sentiment="Positiva")
    plan = seen.select("review_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(company,A)" in plan and "EqualTo(sentiment_label,Posi" in plan
    assert "ReadSchema: struct<review_id:string,company:string,sentiment_label:string>" in plan
    for c in ["title", "body", "author", "date_published", "location", "source_url"]:
        df = df.withColumn(c, F.lit("x"))
    write.write_company_csv(df.withColumn("rating", F.lit(1.0)), str(tmp_path / "c"))
    one = read.read_company_csv(spark, str(tmp_path / "c")).where("slug = 's'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slug" in plan and one.count() == 1


def test_table_lifecycle(spark):
    name = "t_" + os.path.basename(scratch_dir(spark)).replace("-", "_")
    path = scratch_dir(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    write.create_table_like(df, name, path=path)
    assert spark.table(name).count() == 0 and dict(spark.table(name).dtypes)["x"] == "bigint"
    with pytest.raises(ValueError):
        write.create_table_like(df, name)
    assert write.write_table(write.to_warehouse(df), name, "fail", path) == 2
    with pytest.raises(ValueError):
        write.write_table(write.to_warehouse(df), name, "fail", path)
    assert write.write_table(write.to_warehouse(df), name, "append", path) == 2
    assert read.read_table(spark, name).count() == 4
    assert write.load_table(df, name, path) == 2
    assert sorted(map(tuple, read.read_table(spark, name).collect())) == [(1, "a"), (2, "b")]
    assert write.write_table(df.limit(1), name, "whatever", path) == 1
    assert read.read_table(spark, name).count() == 1
    other = write.create_table_like(df.select("y"), name, replace=True, path=scratch_dir(spark))
    assert spark.table(other).columns == ["y"]


def test_warehouse_types():
    given = {
        "s": T.StringType(), "i": T.IntegerType(), "h": T.ShortType(), "f": T.FloatType(),
        "b": T.BooleanType(), "t": T.TimestampType(), "n": T.TimestampNTZType(), "d": T.DateType(),
        "e": T.DecimalType(9, 2), "a": T.ArrayType(T.LongType()),
    }
    schema = warehouse_schema(T.StructType([T.StructField(k, v) for k, v in given.items()]))
    assert [f.dataType.simpleString() for f in schema] == [
        "string", "bigint", "bigint", "double", "boolean", "timestamp", "timestamp", "string", "string", "string",
    ]


def test_materialized_table_cuts_the_lineage(spark):
    df = materialize(spark.range(10).withColumn("x", F.col("id") % 3).repartition(3, "x"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan
    assert df.count() == 10


@pytest.fixture(scope="module")
def crawl(spark):
    pages = materialize(site_pages(spark, SF_DIR))
    specs = companies.company_specs(harvest_list(spark, SF_DIR), order_col="doc_id")
    return pages, specs


def test_second_snapshot_only_for_companies_without_rows(spark, crawl):
    pages, specs = crawl
    first = pages.where("url not like '%/src1.example%'")
    second = pages.withColumn("html", F.replace("html", F.lit('"author"'), F.lit('"nobody"')))
    whole = harvest(pages, specs).groupBy("company").count()
    both = harvest(first, specs, rendered=second)
    assert sorted(map(tuple, both.groupBy("company").count().collect())) == sorted(map(tuple, whole.collect()))
    structured = both.where("source_rank = 0 and author is not null")
    assert structured.where("company = 'src1.example'").count() == 0
    assert structured.where("company = 'src2.example'").count() > 0


def test_harvest_limits(spark, crawl):
    pages, specs = crawl
    capped = harvest(pages, specs, max_reviews=2).groupBy("company").count().collect()
    assert {r["count"] for r in capped} == {2}
    assert harvest(pages, specs, max_pages=0).count() == 0
    with pytest.raises(ValueError):
        harvest(pages, specs, max_reviews=0)


def test_run(spark, crawl):
    pages, specs = crawl
    path = scratch_dir(spark)
    name = "run_" + path.rsplit("-", 1)[1]
    tested = run(pages, specs, shout, name, test_mode=True, first_pause=0.0)
    assert tested.count() <= 3 and tested.columns == CLASSIFIED_COLS
    assert not spark.catalog.tableExists(name)
    loaded = run(pages, specs, shout, name, table_path=path, first_pause=0.0)
    assert loaded.columns == CLASSIFIED_COLS
    assert loaded.count() == read.read_table(spark, name).count() > 100
    assert loaded.where("company <> upper(company)").count() == 0


def test_stream_is_the_batch(spark, folder, tmp_path):
    put = tmp_path / "in"
    os.mkdir(put)
    for i in range(3):
        rows = "".join(f"{n},t,,{n}.0,,,,u\n" for n in range(i, i + 4)) + ",x,,,,,,u\n"
        (put / f"trustpilot_reviews_c{i}.csv").write_text(HEADER + rows)
    (put / "trustpilot_reviews_sample.csv").write_text(HEADER + "99,,,,,,,\n")
    # Another layout: found by name, not by place.
    (put / "trustpilot_reviews_d.csv").write_text('body,review_id,extra,rating\n"a\nb",100,e,100\n')
    unique = streams.stream_dedup(streams.stream_reviews(spark, str(put)))
    name = "stream_" + scratch_dir(spark).rsplit("-", 1)[1]
    query = streams.stream_load(unique, name, scratch_dir(spark), scratch_dir(spark))
    query.awaitTermination()
    rows = spark.table(name).collect()
    assert sorted(r.review_id for r in rows) == sorted(map(str, [*range(6), 100]))
    assert {r.company for r in rows} <= {"C0", "C1", "C2", "D"}
    assert [(r.body, r.title, r.company) for r in rows if r.review_id == "100"] == [("a\nb", None, "D")]
    assert all(r.rating == float(r.review_id) for r in rows)


def failing(spark, columns="id, 'a' as x"):
    return spark.range(10).selectExpr(*columns.split(", ")).withColumn(
        "x", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("x"))
    )


@pytest.mark.parametrize("managed", [True, False])
def test_failed_load_leaves_the_old_rows(spark, managed):
    path = None if managed else scratch_dir(spark)
    name = "kept_" + os.path.basename(scratch_dir(spark)).rsplit("-", 1)[1]
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    with pytest.raises(Exception):
        write.load_table(failing(spark), name, path)
    assert not spark.catalog.tableExists(name)
    for present in (good, good.withColumn("y", F.lit(1).cast("long")), good):
        assert write.load_table(present, name, path) == 2
        for lost in (failing(spark), failing(spark, "id, 'a' as x, 2 as z")):
            with pytest.raises(Exception):
                write.load_table(lost, name, path)
            assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, present.collect()))
    # A table may be replaced by what is made of it; only the last version's files are left.
    assert write.load_table(spark.table(name).withColumn("x", F.upper("x")), name, path) == 2
    assert {r.x for r in spark.table(name).collect()} == {"A", "B"}
    place = write._plain(write._location(spark, name))
    siblings = os.listdir(os.path.dirname(place))
    assert [s for s in siblings if s.startswith(os.path.basename(place).split("version")[0])] == [os.path.basename(place)]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name) and t.name != name]
    write.create_table_like(good, name, replace=True, path=path)
    assert spark.table(name).count() == 0
    spark.sql(f"drop table {name}")


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_a_load_is_loaded_once(spark, mode):
    name = f"once_{mode}_" + scratch_dir(spark).rsplit("-", 1)[1]
    path = scratch_dir(spark)
    first, second = spark.range(3), spark.range(10, 14)
    with pytest.raises(Exception):
        write.load_once(spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), name, "0", mode, path)
    assert write.load_once(first, name, "0", mode, path)
    assert not write.load_once(first, name, "0", mode, path)
    assert write.load_once(second, name, "1", mode, path)
    assert not write.load_once(second, name, "1", mode, path)
    rows = read.read_table(spark, name)
    assert rows.columns == ["id"]
    assert sorted(r.id for r in rows.collect()) == [*([0, 1, 2] if mode == "append" else []), 10, 11, 12, 13]


def test_first_row_wins_in_any_order_of_arrival(spark, tmp_path):
    start = datetime(2024, 1, 1)
    schema = "review_id string, seen timestamp, pos int, body string"
    rows = [("a", start + timedelta(minutes=i), (i * 7 + 3) % 10, None if i % 3 else "x") for i in range(10)]
    rows += [("b", start + timedelta(minutes=i), 5 - i, "y") for i in range(3)] + [("c", None, 0, None)]
    # Beyond what an id is known for, it begins anew; nulls come first.
    rows += [("a", start + timedelta(days=2), 7, "late"), ("a", start + timedelta(days=2, hours=1), None, "later")]
    results = []
    for turn, arriving in enumerate([rows, rows[::-1], rows[5:] + rows[:5]]):
        for i, chunk in enumerate([arriving[:7], arriving[7:], [("end", start + timedelta(days=30), 0, None)]]):
            place = tmp_path / f"in{turn}" / str(i)
            spark.createDataFrame(chunk, schema).coalesce(1).write.parquet(str(place))
            for file in place.glob("*.parquet"):
                os.utime(file, (1e9 + i, 1e9 + i))
        source = spark.readStream.schema(schema).options(maxFilesPerTrigger=1, recursiveFileLookup=True)
        first = streams.stream_first(source.parquet(str(tmp_path / f"in{turn}")), ["pos"], "seen", timedelta(days=1), "10 days")
        name = "first_" + scratch_dir(spark).rsplit("-", 1)[1]
        streams.stream_load(first, name, scratch_dir(spark), scratch_dir(spark)).awaitTermination()
        results.append(sorted(map(tuple, read.read_table(spark, name).collect())))
    assert results[0] == results[1] == results[2]
    assert [(r[0], r[2], r[3]) for r in results[0]] == [("a", 0, None), ("a", None, "later"), ("b", 3, "y")]


def test_ids_share_the_state_of_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "BUCKETS", 4, raising=False)
    start = datetime(2024, 1, 1)
    schema = "id long, seen timestamp, pos int"
    rows = [(i % 40, start + timedelta(hours=i), (i * 7) % 31) for i in range(120)]
    rows += [(None, start, 2), (None, start, 1), (3, start + timedelta(days=9), 5), (3, start + timedelta(days=9), None)]
    parts = [rows[::2], rows[1::2], [(99, start + timedelta(days=30), 0)]]
    for i, chunk in enumerate(parts):
        spark.createDataFrame(chunk, schema).coalesce(1).write.parquet(str(tmp_path / str(i)))
        for file in (tmp_path / str(i)).glob("*.parquet"):
            os.utime(file, (1e9 + i, 1e9 + i))
    source = spark.readStream.schema(schema).options(maxFilesPerTrigger=1, recursiveFileLookup=True).parquet(str(tmp_path))
    first = streams.stream_first(source, ["pos"], "seen", timedelta(hours=50), "10 days", "id")
    name = "shared_" + scratch_dir(spark).rsplit("-", 1)[1]
    query = streams.stream_load(first, name, scratch_dir(spark), scratch_dir(spark))
    query.awaitTermination()
    expected, held = [], {}
    for one, seen, pos in sorted(rows, key=lambda r: r[1]):
        spans = held.setdefault(one, [])
        if not spans or seen > spans[-1][0] + timedelta(hours=50):
            spans.append((seen, []))
        spans[-1][1].append((pos is not None, pos, seen))
    for one, spans in held.items():
        expected += [(one, min(span)[2], min(span)[1]) for _, span in spans]
    got = [tuple(r) for r in read.read_table(spark, name).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    # The store has a key for each bucket, not for each id.
    assert 0 < max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) <= 4


def test_bounded_stream_dedup(spark):
    df = spark.readStream.format("rate").load().selectExpr("cast(value as string) review_id", "timestamp")
    plan = streams.stream_dedup(df, "timestamp", "1 hour")._jdf.queryExecution().logical().toString()
    assert "WithinWatermark" in plan
