"""Reviews, answers, companies and pages made of the given tables.

The row-level definitions are SQL both engines read alike; what only Spark needs
(markup around the values) is added with column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

REVIEWS = """
select
  case when d.doc_id % 37 = 0 then null
       when d.doc_id % 10 = 3 then cast(d.doc_id - 1 as string)
       else cast(d.doc_id as string) end                                   as review_id,
  case when d.doc_id % 7 = 0 then null else regexp_extract(d.text, '^[^.\n]*', 0) end as title,
  case when d.doc_id % 41 = 0 then '' else d.text end                      as body,
  case when d.doc_id % 11 = 0 then null
       else cast(d.doc_id % 6 as double) end                               as rating,
  case when d.doc_id % 13 = 0 then null
       else concat('user', cast(d.doc_id % 97 as string)) end              as author,
  case when d.doc_id % 5 = 0 then ''
       else concat('2024-0', cast(1 + d.doc_id % 9 as string), '-15') end  as date_published,
  case when d.doc_id % 3 = 0 then null else d.lang end                     as location,
  concat('https://reviews.example.com/review/', d.source, '.example?page=',
         cast(1 + d.doc_id % 4 as string))                                 as source_url,
  case when d.source = 'src0' then 'SAMPLE' else upper(d.source) end       as company,
  d.source as source, d.doc_id as ord, l.quality as quality, l.toxic as toxic
from {documents} d left join {labels} l on d.doc_id = l.doc_id
"""
REVIEWS_SQL = REVIEWS.format(documents="documents", labels="labels")

# Labels as the dashboard has them: of the rated documents, else none.
CLASSIFIED = """
select r.*,
  case when quality = 1 then 'Positiva' when quality = 0 then 'Negativa' end as sentiment_label,
  case when quality is null then null
       when ord % 3 = 0 then 'Entrega' when ord % 3 = 1 then 'Repartidor'
       else 'Servicio al cliente' end as general_category,
  case when quality = 1 then case when ord % 2 = 0 then 'Entrega puntual' else 'Entrega rápida' end
       when quality = 0 then case when ord % 4 < 3 then 'Retraso en la entrega' else 'Otros' end
  end as specific_category,
  case when quality is null then 'sin etiqueta' end as error
from {reviews} r
"""
CLASSIFIED_SQL = CLASSIFIED.format(reviews=f"({REVIEWS_SQL})")

_ANSWER_JSON = """concat('{"sentiment_label":"',
    case when coalesce(quality, ord % 2) = 1 then 'Positiva' else 'Negativa' end,
    '","general_category":"',
    case when ord % 3 = 0 then 'Entrega' when ord % 3 = 1 then 'Repartidor'
         else 'Servicio al cliente' end,
    '","specific_category":"',
    case when ord % 23 = 0 then 'Inventada'
         when coalesce(quality, ord % 2) = 1 then 'Entrega puntual'
         else 'Retraso en la entrega' end, '"}')"""

_ANSWER = """case
  when ord % 19 = 0 then 'sin respuesta'
  when ord % 17 = 0 then '{"sentiment_label":"Positiva","general_category":"Entrega"}'
  when ord % 13 = 0 then concat('Resultado: ', js, ' fin')
  when ord % 11 = 0 then concat(js, ' y ', js)
  else js end as answer"""

# What an answer says, told from the row alone.
ANSWER_FAILS = "(ord % 19 = 0 or ord % 17 = 0 or (ord % 13 <> 0 and ord % 11 = 0))"
ANSWER_LABELS = {
    "sentiment_label": "case when coalesce(quality, ord % 2) = 1 then 'Positiva' else 'Negativa' end",
    "general_category": "case when ord % 3 = 0 then 'Entrega' when ord % 3 = 1 then 'Repartidor' "
    "else 'Servicio al cliente' end",
    "specific_category": "case when ord % 23 = 0 then 'Inventada' "
    "when coalesce(quality, ord % 2) = 1 then 'Entrega puntual' else 'Retraso en la entrega' end",
}

# Ten reviews per page and, per company, pages 1, 2, 3, ...
PAGE_NO = "cast(floor(ord / 200) as bigint) + 1"
PAGE_ID = "(cast(floor(ord / 200) as bigint) * 20 + ord % 20)"
POS = "(cast(floor(ord / 20) as bigint) % 10)"
IS_CALL = "(ord % 29 = 0)"
CALL = "Escribe tu reseña"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """The table on all cores, for work that costs more than moving the rows."""
    return table(spark, sf_dir, name).repartition(cores(spark), key)


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def reviews(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    if spread:
        documents = documents.repartition(cores(spark), "doc_id")
    return spark.sql(REVIEWS, documents=documents, labels=table(spark, sf_dir, "labels"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CLASSIFIED, reviews=reviews(spark, sf_dir))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reviews(spark, sf_dir).selectExpr("*", f"{_ANSWER_JSON} as js")
    return rows.selectExpr("ord", "company", "review_id", "quality", _ANSWER)


ANSWERS_SQL = (
    f"select ord, company, review_id, quality, {_ANSWER} "
    f"from (select *, {_ANSWER_JSON} as js from ({REVIEWS_SQL}) r) j"
)

# A company list with a header and a URL in other case for part of the rows;
# names repeat, and the last row of a name counts.
_EMPRESA = """case when doc_id % 50 = 0 then ' ' when doc_id % 2 = 0
  then concat(' ', upper(source), '.example ') else concat(source, '.example') end"""
_ENLACE = """case when doc_id % 20 in (4, 5) then
  concat('https://es.trustpilot.com/review/', source, '.example')
  when doc_id % 3 = 0 then ' ' end"""


def company_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        f"{_EMPRESA} as ` Empresa `", f"{_ENLACE} as `Enlace`", "doc_id"
    )


COMPANY_LIST_SQL = f"select {_EMPRESA} as empresa, {_ENLACE} as enlace, doc_id from documents"


def harvest_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document source, and a company without pages."""
    return (
        table(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(F.min("doc_id").alias("doc_id"))
        .selectExpr("concat(source, '.example') as empresa", "doc_id")
        .unionByName(
            table(spark, sf_dir, "documents")
            .agg((F.max("doc_id") + 1).alias("doc_id"))
            .selectExpr("'sin-paginas.example' as empresa", "doc_id")
        )
    )


def escape(c: Column) -> Column:
    out = c
    for char, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]:
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def _element(opening: str, value: Column, closing: str) -> Column:
    """Markup around a value; nothing for null."""
    return F.coalesce(F.concat(F.lit(opening), escape(value), F.lit(closing)), F.lit(""))


def with_calls(rows: DataFrame) -> DataFrame:
    """Some reviews are a call to write one."""
    return rows.withColumn("body", F.when(F.expr(IS_CALL), F.lit(CALL)).otherwise(F.col("body")))


def structured_script(rows: Column) -> Column:
    """A JSON-LD script of an array of review rows."""
    objects = F.transform(
        rows,
        lambda r: F.struct(
            F.lit("Review").alias("@type"),
            F.concat(F.lit("https://h.example/#/schema/Review/www.s/"), r["review_id"]).alias("@id"),
            r["title"].alias("name"),
            r["body"].alias("reviewBody"),
            F.struct(r["rating"].alias("ratingValue")).alias("reviewRating"),
            F.struct(F.lit("Person").alias("@type"), r["author"].alias("name")).alias("author"),
            F.concat(F.lit(" "), r["date_published"], F.lit(" ")).alias("datePublished"),
        ),
    )
    graph = F.to_json(F.struct(objects.alias("@graph")))
    return F.concat(F.lit('<script type="application/ld+json">'), graph, F.lit("</script>"))


def site_markup(rows: Column) -> Column:
    """An array of review rows in the review site's markup."""
    articles = F.transform(
        rows,
        lambda r: F.concat(
            _element('<article data-service-review-id="', F.coalesce(r["review_id"], F.lit("")), '"'),
            _element(' data-service-review-rating="', r["rating"].cast("string"), '"'),
            F.lit(">"),
            _element("<a data-consumer-profile-reviews-link href=/u>", r["author"], "</a>"),
            _element("<span data-consumer-country-flag title='", r["location"], "'></span>"),
            _element("<h5><strong>", r["title"], "</strong></h5>"),
            _element("<p>", r["body"], "<p>fin<br>"),
            _element('<time datetime="', r["date_published"], '"></time>'),
            F.lit("</article>"),
        ),
    )
    return F.array_join(articles, "\n")


def generic_markup(rows: Column) -> Column:
    """An array of review rows as microdata."""
    items = F.transform(
        rows,
        lambda r: F.concat(
            F.lit('<div itemprop="review" itemscope itemtype="https://schema.org/Review"'),
            _element(' data-review-id="', r["review_id"], '"'),
            F.lit(">"),
            _element('<h3 itemprop="name">', r["title"], "</h3>"),
            _element('<meta itemprop="ratingValue" content="', r["rating"].cast("string"), '">'),
            _element(
                '<span itemprop="author"><i itemprop="name">', r["author"], "</i></span>"
            ),
            _element('<div itemprop="description">', r["body"], "</div>"),
            _element('<time itemprop="datePublished" datetime="', r["date_published"], '">-</time>'),
            _element('<span itemprop="address">', r["location"], "</span>"),
            F.lit("</div>"),
        ),
    )
    return F.array_join(items, "\n")


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, source, page_no, rows``: the ten reviews of each page, in order."""
    rows = with_calls(reviews(spark, sf_dir, spread=True))
    fields = ["review_id", "title", "body", "rating", "author", "date_published", "location"]
    return (
        rows.selectExpr("*", f"{PAGE_ID} as page_id", f"{PAGE_NO} as page_no")
        .groupBy("page_id", "source", "page_no")
        .agg(F.array_sort(F.collect_list(F.struct("ord", *fields))).alias("rows"))
    )


def site_url() -> Column:
    first = F.concat(
        F.lit("https://es.trustpilot.com/review/"), F.col("source"), F.lit(".example")
    )
    return F.when(F.col("page_no") == 1, first).otherwise(
        F.concat(first, F.lit("?page="), F.col("page_no"))
    )


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review site's pages: structured data and markup of the same reviews."""
    html = F.concat(
        F.lit("<html><head>"),
        structured_script(F.col("rows")),
        F.lit("</head><body>"),
        site_markup(F.col("rows")),
        F.lit("</body></html>"),
    )
    return page_rows(spark, sf_dir).select("page_id", site_url().alias("url"), html.alias("html"))


def other_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another site's pages, with microdata."""
    url = F.concat(
        F.lit("https://reviews.example.com/review/"),
        F.col("source"),
        F.lit(".example?page="),
        F.col("page_no"),
    )
    return page_rows(spark, sf_dir).select(
        "page_id", url.alias("url"), generic_markup(F.col("rows")).alias("html")
    )


OTHER_URL_SQL = (
    "concat('https://reviews.example.com/review/', source, '.example?page=', "
    f"cast({PAGE_NO} as string))"
)
SITE_URL_SQL = (
    "concat('https://es.trustpilot.com/review/', source, '.example', "
    f"case when {PAGE_NO} > 1 then concat('?page=', cast({PAGE_NO} as string)) else '' end)"
)
