"""WARC archives: a writer with identical-payload revisits and a sequential reader.

Every record is one gzip member, so archives can be split and concatenated at
record borders. Tasks compress records; the files themselves are written by
Spark's text sink, so task commits, retries and any Hadoop file system come
for free. The sink ends each row with a separator byte; the last byte of a
member is the high byte of its length, 0 below 16 MiB, so with the separator
0 that byte is simply left out of the row. A longer record keeps it, and the
separator becomes zero padding, which gzip readers skip.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, pin, small

#: Uncompressed bytes from which on a task begins its next archive; the reader has one archive in memory at a time.
ARCHIVE_BYTES = 96 << 20
CHUNK = 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit has the headers of the HTTP response but no payload."""
    digest = sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    page = "" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else f'urn:page:{page}'}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"X-Page-Id: {page}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def payload_bytes(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def mark_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Adds ``_first`` and ``_revisit``: of equal payloads of at least ``min_bytes`` the smallest id is kept.

    Payloads are compared by SHA-256, so what is shuffled is a digest and an id
    per page, summed up map-side: a payload that a third of all pages share
    is one row per task. Null ids come last; rows that repeat the smallest id
    are all responses.
    """
    key = F.unhex(F.sha2(payload_bytes(F.col(html_col)), 256))
    seen = pages.filter(F.length(payload_bytes(F.col(html_col))) >= min_bytes).select(key.alias("_key"), F.col(id_col).alias("_id"))
    shared = pin(seen.groupBy("_key").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"))
    joined = pages.withColumn("_key", F.when(F.length(payload_bytes(F.col(html_col))) >= min_bytes, key)).join(small(shared), "_key", "left").drop("_key")
    return joined.withColumn("_revisit", F.col("_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_first")))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per page; null html is an empty payload, null urls become ``urn:page:<id>``.

    A task counts what it has written and names each record's archive after it,
    so an archive is only larger than ``archive_bytes`` by its last record.
    """
    pages = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    marked = mark_revisits(pages, min_bytes, "page", "html")

    def build(batches):
        written = 0
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            members, archives = [], []
            for page, url, html, first, revisit in rows:
                record = build_record(page, url, (html or "").encode(), first, revisit)
                member = gzip_member(record)
                members.append(member if member[-1] else member[:-1])
                archives.append(written // archive_bytes)
                written += len(record)
            yield pa.RecordBatch.from_arrays([pa.array(archives, pa.int32()), pa.array(members, pa.binary())], names=["archive", "member"])

    rows = marked.select("page", "url", "html", "_first", "_revisit").mapInArrow(build, "archive int, member binary")
    rows.select("archive", F.col("member").cast("string").alias("value")).write.partitionBy("archive").option("lineSep", "\0").option("compression", "none").text(path)


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The uncompressed content of each gzip member, unpacked chunk by chunk; zero bytes between members are padding."""
    unpack, parts, began = zlib.decompressobj(31), [], False
    for chunk in chunks:
        while chunk:
            if not began:
                chunk = chunk.lstrip(b"\0")
                if not chunk:
                    break
                began = True
            parts.append(unpack.decompress(chunk))
            chunk = b""
            if unpack.eof:
                yield b"".join(parts)
                chunk, unpack, parts, began = unpack.unused_data, zlib.decompressobj(31), [], False
    if began:
        raise ValueError("the archive ends inside a record")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record framed by its Content-Length."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(headers["content-length"])
    if len(rest) < size + 4 or rest[size : size + 4] != b"\r\n\r\n":
        raise ValueError("the record's length differs from its Content-Length")
    return headers, rest[:size]


def describe(headers: dict[str, str], block: bytes) -> dict:
    """What the reader returns of a record. ``digest_ok`` says whether block and payload have the digests that the headers state."""
    revisit = headers.get("warc-type") == "revisit"
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    ok = headers.get("warc-block-digest") in (None, f"sha1:{sha1_base32(block)}")
    if not revisit:
        ok = ok and (not stated or stated == sha1_base32(payload))
    page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
    return {
        "page_id": int(page) if page else None,
        "record_type": headers.get("warc-type"),
        "refers_to": int(refers) if refers else None,
        "target_uri": headers.get("warc-target-uri"),
        "record_id": headers.get("warc-record-id"),
        "payload_bytes": int(length[1]) if revisit and length else len(payload),
        "payload_digest": stated or sha1_base32(payload),
        "digest_ok": ok,
        "payload": None if revisit else payload,
    }


RECORD = pa.schema(
    [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()), ("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("payload", pa.binary())]
)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of every archive under ``path``, read by Spark, so from any file system.

    Without ``payload`` the payloads stay in the task. A record that is cut off
    or misframed fails the read; a digest that does not match is reported.
    """
    schema = RECORD if payload else pa.schema([f for f in RECORD if f.name != "payload"])

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                view = memoryview(content.as_buffer())
                rows, size = [], 0
                for data in members(bytes(view[i : i + CHUNK]) for i in range(0, len(view), CHUNK)):
                    rows.append(describe(*parse_record(data)))
                    if not payload:
                        del rows[-1]["payload"]
                    size += len(data) if payload else 400
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    types = "page_id long, record_type string, refers_to long, target_uri string, record_id string, payload_bytes long, payload_digest string, digest_ok boolean"
    return files.mapInArrow(read, types + ", payload binary" * payload)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, without payloads. An empty table gives no rows."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4()}"
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok", "target_uri", "record_id")
