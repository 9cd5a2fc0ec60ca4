"""Page chains against a loop over one company's links."""

import random

import pytest

from reviewlake.operators.chain import one_per_url, page_chain


def walk(links, start, max_pages):
    seen, url = [], start
    while url in links and url not in seen and (max_pages is None or len(seen) < max_pages):
        seen.append(url)
        url = links[url]
    return [(start, u, i) for i, u in enumerate(seen)]


@pytest.mark.parametrize("max_pages", [0, 1, 2, 7, 500, None])
def test_chains(spark, max_pages):
    rnd = random.Random(str(max_pages))
    # A third of all pages lead to the same one.
    links = {
        f"u{i}": "u7" if rnd.random() < 0.3 else rnd.choice([f"u{i + 1}", f"u{rnd.randrange(90)}", None, "gone"])
        for i in range(80)
    }
    starts = ["u0", "u11", "u40", "u79", "nowhere"]
    df = spark.createDataFrame(list(links.items()), "url string, next_url string")
    firsts = spark.createDataFrame([(s,) for s in starts], "start string")
    got = sorted(map(tuple, page_chain(df, firsts, max_pages).collect()))
    assert got == sorted(row for s in starts for row in walk(links, s, max_pages))


def test_long_chain_with_hot_pages(spark):
    links = {f"u{i}": f"u{i + 1}" for i in range(40)} | {f"v{i}": "u0" for i in range(60)}
    df = spark.createDataFrame(list(links.items()), "url string, next_url string")
    firsts = df.select(df.url.alias("start"))
    got = sorted(map(tuple, page_chain(df, firsts, 30).collect()))
    assert got == sorted(row for s in links for row in walk(links, s, 30))


def test_one_snapshot_per_url(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "a", "y"), (3, "b", "z")], "page_id int, url string, html string")
    assert sorted(r.html for r in one_per_url(df).collect()) == ["y", "z"]
