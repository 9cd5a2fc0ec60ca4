"""Text, rating and URL functions, against examples and against plain Python."""

import re
from urllib.parse import parse_qs, urlencode, urlparse

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from reviewlake.functions import text, urls


def apply(spark, function, values, result="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


EXAMPLES = [
    (text.normalize_text, " a\t b\n ", "a b"),
    (text.normalize_text, "  \x1f　", None),
    (text.normalize_text, "", None),
    (text.normalize_text, None, None),
    (text.norm, None, ""),
    (text.norm, "  x  ", "x"),
    (text.clean_review_id, "https://h/#/schema/Review/www.d/AB12", "AB12"),
    (text.clean_review_id, "https://h/Review/www.d/AB-12", "https://h/Review/www.d/AB-12"),
    (text.clean_review_id, "x", "x"),
    (text.clean_review_id, "", None),
    (text.safe_filename_component, "  ", "reviews"),
    (text.safe_filename_component, "._a.b-_", "a.b"),
    (text.safe_filename_component, "Añ o/é", "A_o"),
    (text.slugify_company, "a & b", "a___b"),
    (text.slugify_company, "", "empresa"),
    (text.slugify_company, None, "empresa"),
    (text.slugify_company, " DHL  Express ", "dhl_express"),
    (text.company_from_path, "trustpilot_reviews_dhl%20espa%C3%B1a+x.csv", "DHL ESPAÑA+X"),
    (text.company_from_path, "otro.csv", "OTRO"),
    (text.rating_out_of, "Rated 4 out of 5", 4.0),
    (text.rating_out_of, "3.5/5", 3.5),
    (text.rating_out_of, "4 OUT OF 5 stars", 4.0),
    (text.rating_out_of, "cinco", None),
    (text.rating_first_number, "nota: 4.5 de 5", 4.5),
    (text.rating_first_number, "-", None),
    (urls.company_from_url, "https://es.trustpilot.com/review/sending.es", "sending.es"),
    (urls.company_from_url, "https://es.trustpilot.com/Review/www.dhl.com?page=2", "dhl.com"),
    (urls.company_from_url, "http://www.x.com:80/a b", "x.com_80"),
    (urls.company_from_url, "nada", "reviews"),
    (urls.review_url, "sending.es", "https://es.trustpilot.com/review/sending.es"),
    (urls.review_url, " dhl ", "https://es.trustpilot.com/review/www.dhl.com"),
    (urls.review_url, "HTTP://x", "HTTP://x"),
    (urls.review_url, "a\\b", "https://es.trustpilot.com/review/a\\b"),
    (urls.review_url, None, "https://es.trustpilot.com/review/sending.es"),
    (urls.is_site_host, "https://ES.Trustpilot.com/review/x", True),
    (urls.is_site_host, "https://x.com/trustpilot.com", False),
    (urls.increment_page, "u?page=2", "u?page=3"),
    (urls.increment_page, "u", "u?page=2"),
    (urls.increment_page, "u?page=x", None),
    (urls.increment_page, "u?page=" + "9" * 40, "u?page=1" + "0" * 40),
    (urls.increment_page, "u?page=%2B0_99", "u?page=100"),
    (urls.increment_page, "u?page=-100", "u?page=-99"),
    (urls.increment_page, "u?page=-1", "u?page=0"),
    (urls.increment_page, "u?page=-0", "u?page=1"),
    (urls.increment_page, "u?page=0", "u?page=1"),
    (urls.increment_page, "http://h/p?a=1&page=&b=%zz#f", "http://h/p?a=1&b=%25zz&page=2#f"),
]


@pytest.mark.parametrize("function", {f for f, _, _ in EXAMPLES}, ids=lambda f: f.__name__)
def test_examples(spark, function):
    cases = [(v, r) for f, v, r in EXAMPLES if f is function]
    assert apply(spark, function, [v for v, _ in cases]) == [r for _, r in cases]


NUMBERS = [
    " 4 ", "4,5", "4.5d", "4.5f", "1e3", "1E-2", "+.5", "5.", ".", "", "1_000", "1__0", "_1",
    "0x10", "inf", "-Infinity", "12 3", "４", " 3.0 ", "1e", "--1", "1e400",
]


def test_rating_float_reads_what_python_reads(spark):
    def python(s):
        try:
            return float(s)
        except ValueError:
            return None

    values = [n for n in NUMBERS if n.isascii() or "４" not in n]
    assert apply(spark, text.rating_float, values) == [python(v) for v in values]


def test_rating_float_nan(spark):
    (value,) = apply(spark, text.rating_float, ["nan"])
    assert value != value


def test_output_name(spark):
    df = spark.createDataFrame([("a b",), ("",), (None,)], "c string")
    url = F.lit("https://es.trustpilot.com/review/x.es")
    names = [r.n for r in df.select(urls.output_name(url, F.col("c")).alias("n")).collect()]
    assert names == [f"trustpilot_reviews_{n}.csv" for n in ("a_b", "x.es", "x.es")]


def test_author_name(spark):
    df = spark.createDataFrame(
        [("Ana", False, None), (None, True, "Eva"), (None, True, None), (None, False, "x")],
        "a string, o boolean, n string",
    )
    got = df.select(text.author_name(F.col("a"), F.col("o"), F.col("n")).alias("r")).collect()
    assert [r.r for r in got] == ["Ana", "Eva", None, None]


def test_fingerprint_example(spark):
    df = spark.createDataFrame(
        [("", "Ana", "áé"), ("7", "x", "y"), (None, None, None)], "i string, a string, b string"
    )
    got = [r[0] for r in df.select(text.fingerprint(F.col("i"), F.col("a"), F.col("b"))).collect()]
    assert got[0] == "ab::6bc6ff6778f348a536a61e8179d959cd8fd2768f"
    assert got[1] == "id::7"
    assert got[2] == "ab::3eb416223e9e69e6bb8ee19793911ad1ad2027d8"  # of "|"


MESSY = st.text(
    alphabet=st.sampled_from("ab é.\t\n\x0b\x1c\x85\xa0    　​&"),
    max_size=12,
)
PARAMETERS = st.text(alphabet=st.sampled_from("page=&12+%4á*~ab-"), max_size=14)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(MESSY, min_size=40, max_size=60))
def test_white_space_is_pythons(spark, values):
    expected = [re.sub(r"\s+", " ", v.replace("\xa0", " ")).strip() or None for v in values]
    assert apply(spark, text.normalize_text, values) == expected
    assert apply(spark, text.norm, values) == [v.strip() for v in values]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PARAMETERS, min_size=40, max_size=60))
def test_next_page_is_pythons(spark, values):
    def python(url):
        parsed = urlparse(url)
        query = {k: v[0] for k, v in parse_qs(parsed.query).items()}
        try:
            page = int(query.get("page", 1))
        except ValueError:
            return None
        query["page"] = str(page + 1)
        return parsed._replace(query=urlencode(query)).geturl()

    pages = [f"http://h/p?{v}" for v in values]
    assert apply(spark, urls.increment_page, pages) == [python(p) for p in pages]
