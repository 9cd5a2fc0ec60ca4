r"""WARC archives: written as one gzip stream a file, normalised, read back.

Some tools write an archive as a single gzip stream, so that its last record can only
be had by inflating all before it. The normaliser inflates each such file once, from
its start to its end, writes every record as a gzip member of its own, and writes a
sidecar index with each record's offset and length, by which a record can be read alone.

All files are written by Spark's own text writer, whose commit protocol deals with lost
and repeated tasks on every file system:

* A record ends with ``\r\n\r\n``, which is the writer's line separator; the writer's
  gzip codec makes the file one stream.
* A gzip member ends with the high byte of its content's length, 0 below 16 MiB, which
  is the writer's separator in the normalised files: the member's other bytes are the
  value. A longer record is followed by the 20 bytes of an empty member.

A file's content is one value in memory (``binaryFile`` takes up to 2 GB), as files are
as large as the partition of pages they come from, compressed; its inflated bytes are
held one record at a time.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the largest
``page_id`` is a response, the others are revisits that refer to it and carry no payload.
The largest ids are found on digests alone, combined in each task before the shuffle;
only the digests that several pages have are joined back.

Defined results: a null html is an empty payload; a null url is left out of the record;
rows without ``page_id`` come before all others, and if no row of a payload has one, all
are responses; rows that repeat the largest id with the same payload are all responses;
an empty table gives an archive without records; columns besides ``page_id, url, html``
are not archived.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import materialize, scratch_dir
from .common import table

MIN_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
CRLF = "\r\n"
EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()
CHUNK = 1 << 20

MEMBERS = "part int, nr long, offset long, length long, record_id string, record_type string, member binary"
RECORDS = (
    "part int, offset long, length long, page_id long, url string, record_type string, refers_to long,"
    " payload_digest string, payload_bytes long, payload binary"
)


def with_roles(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, bytes, record_type, refers_to``."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("bytes"),
    )
    several = materialize(
        rows.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last_id"))
        .where("n > 1")
        .select("digest", "last_id")
    )
    revisits = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return rows.join(several, "digest", "left").select(
        *rows.columns,
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("last_id")).alias("refers_to"),
    )


def record_text(rows: DataFrame) -> DataFrame:
    """One ``value`` per record, without the line ends that close it."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    # A header's value may not hold line ends.
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    urn = "<urn:page:"
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit(f"WARC-Record-ID: {urn}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")),
        F.concat(F.lit(f"WARC-Refers-To: {urn}"), F.col("refers_to").cast("string"), F.lit(">")),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(head, F.lit(CRLF + CRLF), block).alias("value"))


def write_monolithic(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Archives of all pages below ``path``, each one gzip stream."""
    record_text(with_roles(pages, min_bytes)).write.option("lineSep", CRLF + CRLF).option(
        "compression", "gzip"
    ).text(path)


def inflated(content: bytes) -> Iterator[bytes]:
    """The content of all gzip members, in pieces."""
    at = memoryview(content)
    while len(at):
        stream, used = zlib.decompressobj(31), 0
        while not stream.eof and used < len(at):
            piece = stream.decompress(at[used : used + CHUNK])
            used += min(CHUNK, len(at) - used)
            if piece:
                yield piece
        if not stream.eof:
            raise ValueError("the archive ends within a gzip member")
        at = at[used - len(stream.unused_data) :]


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, block and all bytes of each record; holds one record and one piece."""
    buffer, start = bytearray(), 0

    def more() -> bool:
        nonlocal start
        piece = next(pieces, None)
        if piece is None:
            return False
        del buffer[:start]
        start = 0
        buffer.extend(piece)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n", start)) < 0:
            if not more():
                if bytes(buffer[start:]).strip():
                    raise ValueError("the archive ends within a record's header")
                return
        lines = bytes(buffer[start:end]).decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        head, size = end + 4 - start, int(headers["content-length"])
        while len(buffer) - start < head + size + 4:
            if not more():
                raise ValueError("the archive ends within a record")
        whole = bytes(buffer[start : start + head + size + 4])
        start += head + size + 4
        yield headers, whole[head:-4], whole


def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every record of a partition's archives as a gzip member, with its place in the new file."""
    from pyspark import TaskContext

    part, offset, nr, rows, held = TaskContext.get().partitionId(), 0, 0, [], 0
    for batch in batches:
        for content in batch["content"]:
            for headers, _, whole in split_records(inflated(content)):
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(whole) + packer.flush()
                length = len(member)
                if member[-1]:
                    member += EMPTY_MEMBER
                rows.append(
                    (part, nr, offset, length, headers.get("warc-record-id"), headers.get("warc-type"), member[:-1])
                )
                offset, nr, held = offset + len(member), nr + 1, held + len(member)
                if held > 8 * CHUNK:
                    yield pd.DataFrame(rows, columns=[c.split()[0] for c in MEMBERS.split(", ")])
                    rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in MEMBERS.split(", ")])


def normalise(spark: SparkSession, source: str, archive: str, index: str) -> None:
    """Writes the archives below ``source`` with a member per record, and their index.

    The index has ``part, nr, offset, length, record_id, record_type``; ``part`` is the
    number in the new file's name. Both are written from one pass over the source.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    rows = files.select("content").mapInPandas(members, MEMBERS).persist(StorageLevel.DISK_ONLY)
    try:
        rows.drop("member").write.parquet(index)
        rows.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(archive)
    finally:
        rows.unpersist()


def read_member(content: bytes, offset: int) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Records from ``offset`` on, each with its member's length."""
    while offset < len(content):
        stream, used, out = zlib.decompressobj(31), offset, []
        while not stream.eof:
            piece = content[used : used + CHUNK]
            if not piece:
                raise ValueError("the archive ends within a gzip member")
            out.append(stream.decompress(piece))
            used += len(piece)
        length = used - len(stream.unused_data) - offset
        for headers, block, _ in split_records(iter(out)):
            yield headers, block, length
        offset += length


def page_number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``RECORDS`` of the members of normalised files, their digests computed anew."""
    import hashlib

    for batch in batches:
        for name, content, offsets in zip(batch["path"], batch["content"], batch["offsets"], strict=True):
            part, rows, held = int(name.rpartition("/part-")[2][:5]), [], 0
            for offset in offsets:
                headers, block, length = next(read_member(content, int(offset)))
                payload = block.partition(b"\r\n\r\n")[2]
                revisit = headers["warc-type"] == "revisit"
                rows.append(
                    (
                        part,
                        int(offset),
                        length,
                        page_number(headers["warc-record-id"]),
                        headers.get("warc-target-uri"),
                        headers["warc-type"],
                        page_number(headers.get("warc-refers-to")),
                        headers["warc-payload-digest"].removeprefix("sha1:")
                        if revisit
                        else hashlib.sha1(payload).hexdigest(),
                        int(headers["x-payload-length"]) if revisit else len(payload),
                        None if revisit else payload,
                    )
                )
                held += len(payload)
                if held > 8 * CHUNK:
                    yield frame(rows)
                    rows, held = [], 0
            yield frame(rows)


def frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in RECORDS.replace(" string, refers", " string,refers").replace(",", ", ").split(", ")]
    out = pd.DataFrame(rows, columns=[n for n in names if n])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archive(spark: SparkSession, archive: str, index: DataFrame) -> DataFrame:
    """``RECORDS`` at the places that ``index`` names, each member inflated alone."""
    places = index.groupBy("part").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(archive)
        .select("path", "content", F.regexp_extract("path", r"/part-(\d+)", 1).cast("int").alias("part"))
    )
    return files.join(places, "part").select("path", "content", "offsets").mapInPandas(records, RECORDS)


def op10_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark)
    source, archive, index = f"{base}/source", f"{base}/archive", f"{base}/index"
    write_monolithic(table(spark, sf_dir, "pages"), source)
    normalise(spark, source, archive, index)
    back = read_archive(spark, archive, spark.read.parquet(index))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
with p as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as payload_digest,
    octet_length(encode(coalesce(html, ''))) as payload_bytes from pages),
last as (select payload_digest, max(page_id) as last_id from p where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when page_id is distinct from last_id and last_id is not null then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from last_id then last_id end as refers_to
from p left join last using (payload_digest)
"""

QUERIES = {"op10_warc_roundtrip": (op10_warc_roundtrip, SQL)}
