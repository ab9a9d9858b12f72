"""Web archives, index first.

Digests are counted first, so that it is known which record is a response and which revisits another. A record's headers
follow from the page's small columns, so its length and its offset are known before its bytes are written. Each task
writes the records of its part of the scan to archives of its own, without a shuffle of payloads, and gives the index
rows: offset, length, url and digest of every record. The index is committed by Spark and names only the archives of accepted attempts;
what a lost task left behind is in no index row. From there on only the index is read: selecting takes index rows, sorts them by archive and
offset, joins neighbouring byte ranges and reads those, nothing else; every payload is digested again and compared.

Records are WARC/1.1, uncompressed so that any range can be read. A revisit has the response's headers and no body.
Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest key is the response.

Defined cases: a null payload is empty. A null key is written as ``none`` and read back as null; it is never the
response if another key is there. Rows equal in key and payload are all responses if theirs is the largest key. A null
url has no target header; blanks and control characters in a url become ``%20``. Other columns are not read. An empty
table gives no archive and no rows. A hot payload is counted before any shuffle, and its revisits have no body. The
table of repeated payloads is broadcast if its measured size allows; else it is joined, and payloads are shuffled once.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annoframe.llm.common import partitions
from annoframe.session import scratch_dir

ARCHIVE_BYTES = 1 << 30
#: Ranges at most so far apart are read as one, up to so many bytes at a time.
GAP, CHUNK = 1 << 16, 8 << 20
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: RFC 4648 (fixed values).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 hexadecimal digits are eight groups of four letters."""
    digest = F.sha1(text)
    letters = []
    for g in range(8):
        bits = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _name(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def _head(revisit: Column) -> Column:
    """All of a record up to its payload, from the small columns."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    length = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")
    lines = [
        F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), _name(F.col("key"))),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _name(F.col("response")), F.lit(f"\r\nWARC-Profile: {PROFILE}"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), http)


def _revisits() -> Column:
    """True where the payload has a response under another key."""
    return F.coalesce(F.col("response").isNotNull() & ~F.col("key").eqNullSafe(F.col("response")), F.lit(False))


INDEX = "key long, url string, digest string, bytes long, type string, refers_to long, archive string, offset long, length long"


def _archive(home: str, limit: int):
    """A task that writes records to archives of about ``limit`` bytes and gives their index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, offset = None, "", 0
        try:
            for batch in batches:
                archives, offsets, lengths = [], [], []
                for head, body in zip(batch.column("head"), batch.column("body")):
                    if out is not None and offset >= limit:
                        out.close()
                        out = None
                    if out is None:
                        uri, offset = f"{home}/{uuid.uuid4().hex}.warc", 0
                        system, path = fs.FileSystem.from_uri(uri)
                        system.create_dir(os.path.dirname(path), recursive=True)
                        out = system.open_output_stream(path, buffer_size=1 << 20)
                    parts = (head.as_buffer(), body.as_buffer(), END.encode())
                    for part in parts:
                        out.write(part)
                    size = sum(map(len, map(memoryview, parts)))
                    archives.append(uri)
                    offsets.append(offset)
                    lengths.append(size)
                    offset += size
                small = [batch.column(c) for c in ("key", "url", "digest", "bytes", "type", "refers_to")]
                yield pa.RecordBatch.from_arrays(
                    [*small, pa.array(archives, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    [c.split()[0] for c in INDEX.split(", ")],
                )
        finally:
            if out is not None:
                out.close()

    return run


def write(
    pages: DataFrame, home: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write archives and index under ``home`` and return the index: ``key``, ``url``, ``digest``, ``bytes``, ``type``,
    ``refers_to``, ``archive``, ``offset``, ``length``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"), base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes")
    )
    groups = rows.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("response"))
    groups.where("n > 1").select("digest", "response").write.parquet(f"{home}/repeated")
    repeated = spark.read.schema("digest string, response long").parquet(f"{home}/repeated")
    records = rows.join(repeated, "digest", "left").select(
        "key",
        "url",
        "digest",
        "bytes",
        F.when(_revisits(), F.lit("revisit")).otherwise(F.lit("response")).alias("type"),
        F.when(_revisits(), F.col("response")).alias("refers_to"),
        _head(_revisits()).cast("binary").alias("head"),
        F.when(_revisits(), F.lit("")).otherwise(F.col("payload")).cast("binary").alias("body"),
    )
    records.mapInArrow(_archive(f"{home}/archives", archive_bytes), INDEX).write.parquet(f"{home}/index")
    return spark.read.schema(INDEX).parquet(f"{home}/index")


def _ranges(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Neighbouring (offset, length) as (start, end, which)."""
    start = end = 0
    which: list[int] = []
    for i, (offset, length) in enumerate(rows):
        if which and (offset > end + GAP or offset + length > start + CHUNK):
            yield start, end, which
            which = []
        if not which:
            start = offset
        end = max(end, offset + length) if which else offset + length
        which.append(i)
    if which:
        yield start, end, which


def parse(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of one record."""
    fields = lambda raw: {k.lower(): v for k, _, v in (line.partition(": ") for line in raw.decode().split("\r\n")[1:])}
    head, _, rest = record.partition(END.encode())
    headers = fields(head)
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(END.encode())
    return headers, fields(http), payload


def _page(name: str | None) -> int | None:
    text = (name or "<urn:page:none>").removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def read(spark: SparkSession, home: str, selected: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """The records of the ``selected`` index rows (all of them if None), read from the archives by byte range.

    Without ``payloads`` they are read and checked, but not returned.
    """
    index = spark.read.schema(INDEX).parquet(f"{home}/index") if selected is None else selected
    schema = "key long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"
    if index.isEmpty():
        return spark.createDataFrame([], schema)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            rows = batch.to_pydict()
            lo, n = 0, batch.num_rows
            while lo < n:
                hi = next((i for i in range(lo, n) if rows["path"][i] != rows["path"][lo]), n)
                if rows["path"][lo] != path:
                    path = rows["path"][lo]
                    system, at = fs.FileSystem.from_uri(path)
                    file = system.open_input_file(at)
                spans = list(zip(rows["offset"][lo:hi], rows["length"][lo:hi]))
                for start, end, which in _ranges(spans):
                    file.seek(start)
                    data = file.read(end - start)
                    out: list[tuple] = []
                    for i in which:
                        headers, http, payload = parse(data[spans[i][0] - start : spans[i][0] - start + spans[i][1]])
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        if headers["warc-type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{path} at {spans[i][0]}: the payload does not match its digest")
                        if digest != rows["digest"][lo + i]:
                            raise ValueError(f"{path} at {spans[i][0]}: not the record of the index")
                        whole = headers["warc-type"] == "response"
                        out.append(
                            (_page(headers["warc-record-id"]), headers.get("warc-target-uri"), len(payload) if whole else int(http["content-length"]), digest, headers["warc-type"], _page(headers.get("warc-refers-to")), payload.decode() if whole and payloads else None)
                        )
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                    names = ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                lo = hi

    ordered = index.select(F.col("archive").alias("path"), "offset", "length", "digest")
    # Ranges, so that every task has about as many records, and an archive few readers.
    ordered = ordered.repartitionByRange(partitions(spark), "path", "offset").sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(run, schema)


def new_home(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"


def report(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """What the archives of all pages say, read back."""
    spark, home = pages.sparkSession, new_home(pages.sparkSession)
    write(pages, home, key, url, html)
    return read(spark, home, payloads=False).select(F.col("key").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")


def sql() -> str:
    """The same in DuckDB, but for the base32 digest, which is spelled from the bits."""
    letters = " || ".join(
        f"substr('{BASE32}', (((('0x' || substr(sha1(p), {5 * g + 1}, 5))::BIGINT >> {shift}) & 31) + 1)::BIGINT, 1)" for g in range(8) for shift in (15, 10, 5, 0)
    )
    return f"""
WITH r AS (SELECT page_id, strlen(p)::BIGINT AS payload_bytes, {letters} AS payload_digest FROM (SELECT page_id, coalesce(html, '') AS p FROM pages)),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM r)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM m
"""
