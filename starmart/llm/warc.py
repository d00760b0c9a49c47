"""Legacy ARC archives converted to WARC, written and read back.

ARC is parsed by its declared lengths: the version block (``filedesc://``) says in its second
line which version the archive has; version 1 headers have five fields, version 2 headers ten (result
code, checksum, location, offset and file name before the length). Each record becomes a WARC/1.0 record with a
synthesised identifier (a name-based UUID of archive and offset), the date in ISO form, the
payload's SHA-1 digest in base32 and the type: of records with equal payloads (digest
and length) the one with the smallest page id is the response, the others revisit it, with
``WARC-Refers-To`` and without the payload.

Archives go through Spark: each output row is a whole archive of at most ``RECORDS`` records and about
``ARCHIVE_BYTES``, written by Spark's text writer (so a repeated task leaves no halves) with gzip into the shared
folder and read as binary files. The only shuffles are of digests, to find the responses, and of the
records that carry their payload to them. A payload held by a third of all records
is aggregated before its shuffle, and Spark splits the skewed join.

Defined results: a null payload is empty. Records whose page id is null are never referred to: in a
group without any id all are responses. Rows that share the smallest id are all responses. A url without
value is written as ``-``; blanks and control characters in a url are percent-encoded. An empty table gives no archive
and no rows. Further columns aren't archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import keep, mapped, shared, ship

RECORDS = 1000
ARCHIVE_BYTES = 8 << 20
DATE = "20240101000000"  # the pages table has no capture time
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # URLs, RFC 4122
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}


def _escape(url: str | None) -> str:
    if not url:
        return "-"
    return "".join(c if c > " " and c != "\x7f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_version_block(version: int, name: str) -> bytes:
    names = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
    body = f"{version} 0 starmart\n{names[version]}\n\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {DATE} text/plain " + ("" if version == 1 else f"200 - - 0 {name} ")
    return f"{head}{len(body)}\n".encode() + body


def arc_record(version: int, name: str, offset: int, url: str | None, block: bytes) -> bytes:
    more = "" if version == 1 else f"200 - - {offset} {name} "
    return f"{_escape(url)} 0.0.0.0 {DATE} text/html {more}{len(block)}\n".encode() + block + b"\n"


def http_block(page_id: int | None, payload: bytes) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(path, content): the pages as ARC archives; tasks write versions 1 and 2 by turns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        parts: list[bytes] = []
        size = n = 0

        def begin():
            version = 1 + number % 2
            name = f"part-{part:05d}-{number:05d}.arc"
            return version, name, [arc_version_block(version, name), b"\n"]

        version, name, parts = begin()
        size = sum(map(len, parts))
        for batch in batches:
            for i in range(batch.num_rows):
                html = batch["html"][i].as_py()
                rec = arc_record(version, name, size, batch["url"][i].as_py(), http_block(batch["id"][i].as_py(), (html or "").encode()))
                parts.append(rec)
                size, n = size + len(rec), n + 1
                if n >= RECORDS or size >= ARCHIVE_BYTES:
                    yield _archive(name, b"".join(parts))
                    number, n = number + 1, 0
                    version, name, parts = begin()
                    size = sum(map(len, parts))
        if n:
            yield _archive(name, b"".join(parts))

    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return mapped(src, task, "path string, content binary")


def _archive(name: str, content: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["path", "content"])


def parse_arc(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of each record after the version block."""
    at, version = 0, 1
    while at < len(content):
        if content[at : at + 1] == b"\n":  # between records
            at += 1
            continue
        end = content.index(b"\n", at)
        values = content[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if values[0].startswith("filedesc://"):
            size = int(values[-1])
            body = content[end + 1 : end + 1 + size]
            version = int(body.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            at = end + 1 + size
            continue
        names = FIELDS[version]
        if len(values) != len(names):
            raise ValueError(f"an ARC version {version} header has {len(names)} fields, not {len(values)}")
        head = dict(zip(names, values))
        size = int(head["length"])
        if end + 1 + size > len(content):
            raise ValueError("an ARC record is shorter than its declared length")
        yield at, head, content[end + 1 : end + 1 + size]
        at = end + 1 + size


def _http(block: bytes) -> tuple[bytes, bytes]:
    """(header with its empty line, payload) of an HTTP message; other content has no header."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def _page_id(head: bytes) -> int | None:
    m = re.search(rb"\r\nX-Page-Id: (-?[0-9]+)\r\n", head)
    return int(m[1]) if m else None


def arc_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Parsed records of (path, content): record_id, page_id, url, date, digest, bytes and, if asked for, http and payload."""
    names = ["record_id", "page_id", "url", "ip", "date", "digest", "bytes"] + ["http", "payload"] * with_payload

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()][: len(names)]
        for batch in batches:
            for i in range(batch.num_rows):
                path, content = batch["path"][i].as_py(), batch["content"][i].as_py()
                rows = []
                for offset, head, block in parse_arc(content):
                    http, payload = _http(block)
                    d = head["date"]
                    iso = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                    row = (f"urn:uuid:{uuid.uuid5(_NAMESPACE, f'{path}#{offset}')}", _page_id(http), head["url"], head["ip"], iso, digest(payload), len(payload))
                    rows.append(row + ((http, payload) if with_payload else ()))
                cols = list(zip(*rows)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()).cast(k) if n in ("http", "payload") else pa.array(c, k) for n, c, k in zip(names, cols, kinds)], names=names)

    schema = "record_id string, page_id long, url string, ip string, date string, digest string, bytes long" + ", http string, payload string" * with_payload
    return mapped(archives, task, schema)


def typed(archives: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records with their type: ``refers_to`` (page id) is null for responses."""
    light = arc_records(archives, with_payload=False)
    first = light.where((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("digest", "bytes").agg(F.min(F.struct("page_id", "record_id")).alias("first"))
    records = arc_records(archives).join(first, ["digest", "bytes"], "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return records.select("*", F.when(other, F.col("first.page_id")).alias("refers_to"), F.when(other, F.col("first.record_id")).alias("refers_record")).drop("first")


def warc_record(r: dict) -> bytes:
    revisit = r["refers_record"] is not None
    http, payload = r["http"].encode(), r["payload"].encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{r['record_id']}>",
        f"WARC-Date: {r['date']}",
        f"WARC-Target-URI: {r['url']}",
        f"WARC-IP-Address: {r['ip']}",
        f"WARC-Payload-Digest: sha1:{r['digest']}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: <{r['refers_record']}>", f"X-Refers-To-Page-Id: {r['refers_to']}"]
    return ("\r\n".join(head) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block


def write_warc(records: DataFrame, path: str) -> None:
    """The typed records as gzipped WARC archives below ``path``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                parts.append(warc_record({n: batch[n][i].as_py() for n in batch.schema.names}))
                size += len(parts[-1])
                if len(parts) >= RECORDS or size >= ARCHIVE_BYTES:
                    yield _whole(parts)
                    parts, size = [], 0
        if parts:
            yield _whole(parts)

    # a row is an archive; the writer's line end is the second half of the last record's end
    rows = mapped(records, task, "value string")
    rows.write.option("maxRecordsPerFile", 1).option("lineSep", "\r\n").option("compression", "gzip").text(path)


def _whole(parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(parts) + b"\r\n"], pa.binary()).cast(pa.string())], names=["value"])


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record, by the declared lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        yield head, content[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record below ``path``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for head, block in parse_warc(zlib.decompress(batch["content"][i].as_py(), 31)):
                    http, payload = _http(block)
                    kind, known = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-block-digest"] != f"sha1:{digest(block)}" or kind == "response" and known != digest(payload):
                        raise ValueError(f"a digest of {head['warc-record-id']} doesn't fit")
                    size = re.search(rb"\r\nContent-Length: ([0-9]+)\r\n", http)
                    ref = head.get("x-refers-to-page-id")
                    rows.append((_page_id(http), int(size[1]) if size else len(payload), known, kind, None if ref is None else int(ref)))
                cols = list(zip(*rows)) if rows else [[] for _ in range(5)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("content")
    return mapped(files, task, schema)


def convert(spark: SparkSession, pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> str:
    """Pages to ARC to WARC; returns the folder of the WARC archives."""
    path = path or shared(spark, "warc")
    # written once: both passes over the archives see the same records at the same offsets
    write_warc(typed(keep(spark, to_arc(pages), "arc", compression="zstd"), least_bytes), path)
    return path


def report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return read_warc(spark, convert(spark, pages))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, h, first, sha1(h) AS x FROM g)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {base32} AS payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to FROM d
""".format(base32="array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(x || '0000000000000000', 1 + ((k * 5) // 4), 3) AS BIGINT) >> (12 - 5 - ((k * 5) % 4))) & 31 AS INTEGER), 1)), '')")
