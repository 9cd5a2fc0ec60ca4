"""Compares registered queries with their SQL. ``python tests/oracle.py SF_DIR [QUERY...]``"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """Lists, and what is in them, as tuples, which can be counted."""
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(map(plain, df.select(*[f"`{c}`" for c in cols]).collect()))


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    return cols, Counter(plain([r[i] for i in at]) for r in rel.fetchall())


def difference(spark, con, sf_dir, name):
    """None if equal, else what differs."""
    cols, got = spark_rows(entry.queries()[name](spark, sf_dir))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    expected_cols, expected = duck_rows(con, sql)
    if cols != expected_cols:
        return f"columns {cols} instead of {expected_cols}"
    if got != expected:
        extra, lacking = got - expected, expected - got
        return (
            f"{sum(got.values())} rows instead of {sum(expected.values())};"
            f" extra {sum(extra.values())}: {[str(x)[:300] for x in list(extra)[:3]]};"
            f" lacking {sum(lacking.values())}: {[str(x)[:300] for x in list(lacking)[:3]]}"
        )
    return None if got else "no rows on both sides"


if __name__ == "__main__":
    from conftest import session

    spark, con = session(), duck(sys.argv[1])
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        started = time.time()
        try:
            diff = difference(spark, con, sys.argv[1], name)
        except Exception as ex:
            diff = f"{type(ex).__name__}: {str(ex)[:1500]}"
        bad += diff is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if diff is None else diff}", flush=True)
    print(f"{bad} of {len(entry.queries())} differ")
