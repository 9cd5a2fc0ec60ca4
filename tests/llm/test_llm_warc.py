"""WARC archives: round trip, normaliser, index."""

import gzip
import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlake.llm import warc
from reviewlake.scratch import scratch_dir

BIG = "<p>ä</p>" * 200


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")


ROWS = [
    (1, "http://a/1", BIG),
    (2, "http://a/2", BIG),
    (3, "http://a/3\r\nX-Evil: 1", BIG),
    (4, None, "small"),
    (5, "u", "small"),
    (6, "u", None),
    (7, "u", ""),
    (None, "u", BIG),
    (None, None, None),
    (8, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40),
    (9, "u", "\x00\r\n\r\n" * 300),
    (9, "u", "\x00\r\n\r\n" * 300),
    (10, "u", "x" * 999),
    (11, "u", "x" * 999),
    (12, "u", "y" * 1000),
    (13, "u", "y" * 1000),
]


def expected(rows):
    digests = [hashlib.sha1((h or "").encode()).hexdigest() for _, _, h in rows]
    sizes = [len((h or "").encode()) for _, _, h in rows]
    last = {}
    for (i, _, _), d, n in zip(rows, digests, sizes):
        if n >= 1000 and i is not None:
            last[d] = max(last.get(d, i), i)
    out = []
    for (i, _, _), d, n in zip(rows, digests, sizes):
        revisit = n >= 1000 and d in last and last[d] != i
        out.append((i, n, d, "revisit" if revisit else "response", last[d] if revisit else None))
    return Counter(out)


def written(spark, rows):
    base = scratch_dir(spark)
    places = [f"{base}/{x}" for x in ("source", "archive", "index")]
    warc.write_monolithic(pages(spark, rows), places[0])
    warc.normalise(spark, *places)
    return places


def local(path):
    path = path.removeprefix("file:")
    return sorted(os.path.join(path, x) for x in os.listdir(path) if x.startswith("part-"))


def test_round_trip(spark):
    source, archive, index = written(spark, ROWS)
    back = warc.read_archive(spark, archive, spark.read.parquet(index))
    got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, got)) == expected(ROWS)
    payloads = Counter((r.page_id, bytes(r.payload).decode()) for r in back.where("payload is not null").collect())
    assert payloads == Counter(
        (i, h or "") for i, _, h in ROWS if not (h == BIG and i != 3) and not (i == 12)
    )
    assert back.where(F.col("url").contains("\n")).count() == 0


def test_source_is_one_stream_and_archive_has_a_member_per_record(spark):
    source, archive, index = written(spark, ROWS)
    places = {}
    for r in spark.read.parquet(index).collect():
        places.setdefault(r.part, []).append((r.offset, r.length, r.record_id))
    whole = b""
    for path in local(source):
        content = open(path, "rb").read()
        stream = warc.zlib.decompressobj(31)
        whole += stream.decompress(content)
        assert stream.eof and not stream.unused_data
    assert whole.count(b"WARC-Record-ID: ") == len(ROWS)
    rewritten = b""
    for path in local(archive):
        content = open(path, "rb").read()
        part = int(os.path.basename(path)[5:10])
        rewritten += gzip.decompress(content) if content else b""
        for offset, length, record in places.get(part, []):
            member = gzip.decompress(content[offset : offset + length])
            assert member.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {record}".encode() in member
            assert member.endswith(b"\r\n\r\n")
        assert sum(n for _, n, _ in places.get(part, [])) == len(content)
    assert Counter(rewritten.split(b"WARC/1.1")) == Counter(whole.split(b"WARC/1.1"))


def test_a_record_beyond_16_mib_is_followed_by_an_empty_member(spark):
    rows = [(1, "u", "z" * (17 << 20)), (2, "u", "after")]
    _, archive, index = written(spark, rows)
    back = warc.read_archive(spark, archive, spark.read.parquet(index))
    got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, got)) == expected(rows)


def test_one_record_can_be_read_alone(spark):
    _, archive, index = written(spark, ROWS)
    one = spark.read.parquet(index).where("record_id = '<urn:page:8>'")
    assert [r.page_id for r in warc.read_archive(spark, archive, one).collect()] == [8]


def test_empty_table(spark):
    _, archive, index = written(spark, [])
    assert warc.read_archive(spark, archive, spark.read.parquet(index)).count() == 0


def test_members_and_broken_streams():
    record = b"WARC/1.0\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    packed = gzip.compress(record * 2) + gzip.compress(record)
    assert [b for _, b, _ in warc.split_records(warc.inflated(packed))] == [b"hi"] * 3
    for broken in (packed[:-10], gzip.compress(record[:-9]), gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises((ValueError, warc.zlib.error)):
            list(warc.split_records(warc.inflated(broken)))
