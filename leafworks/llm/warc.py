"""WARC archives with revisit resolution.

1. Headers only (digest, size, id) are shuffled by payload digest; each digest's smallest id becomes the response,
   the others revisit it. The minimum is combined in each task first, so a digest that a third of all pages
   share moves a row a task.
2. Revisits are written from their headers, and responses where their payload is read: filters tell the scan which
   pages are revisits (see resolved()), so payloads don't move. Each task writes archives with fresh headers into the
   shared folder: responses with payload, revisits without. A file is written under a name of its own attempt, and only
   the files that the manifest lists count, so a task that is lost and run again leaves nothing double.
3. Reading parses the files record by record (each is a gzip member of its own), and joins revisit records to
   the originals they refer to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafworks.llm.line_dedup import without_keys
from leafworks.llm.shared import scratch, small_batches, written

#: Bytes of compressed records after which a task begins the next file.
FILE_BYTES = 64 << 20
#: The record's line ends and version, and the profile of a revisit.
CRLF, VERSION = b"\r\n", b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = "record_id string, record_type string, page_id long, uri string, payload binary, payload_bytes long, payload_digest string, refers_to_id string"


def digest(payload: bytes) -> str:
    """Upper-case base32 of the payload's SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it (`file:/a`, `/a` or a full URI), and the path there."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def record_id(page_id: int | None) -> bytes:
    return b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")).encode()


def one_line(value: str) -> bytes:
    """A header's value: control characters and % are percent-encoded, so that reading gives the same value."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in value).encode()


def from_line(value: bytes) -> str:
    from urllib.parse import unquote

    return unquote(value.decode(), errors="strict")


def record(page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None, revisit: bool, sha1: bytes | None = None) -> bytes:
    head = [
        (b"WARC-Type", b"revisit" if revisit else b"response"),
        (b"WARC-Record-ID", record_id(page_id)),
        (b"WARC-Date", b"1970-01-01T00:00:00Z"),
        (b"WARC-Payload-Digest", b"sha1:" + (base64.b32encode(sha1) if sha1 else digest(payload).encode())),
    ]
    if page_id is not None:
        head.append((b"WARC-Page-ID", b"%d" % page_id))
    if uri is not None:
        head.append((b"WARC-Target-URI", one_line(uri)))
    if revisit:
        head += [(b"WARC-Refers-To", record_id(refers_to)), (b"WARC-Profile", PROFILE)]
    body = b"" if revisit else payload
    head += [(b"Content-Type", b"text/html; charset=utf-8"), (b"Content-Length", b"%d" % len(body))]
    return VERSION + CRLF + b"".join(k + b": " + v + CRLF for k, v in head) + CRLF + body + CRLF + CRLF


def parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(headers, body) of each record of an uncompressed stream."""
    while line := stream.readline():
        if line != VERSION + CRLF:
            raise ValueError(f"not a record's first line: {line[:80]!r}")
        head = {}
        while (line := stream.readline()) != CRLF:
            k, _, v = line[:-2].partition(b": ")
            head[k] = v
        body = stream.read(int(head[b"Content-Length"]))
        if stream.read(4) != CRLF + CRLF:
            raise ValueError("a record's end is missing")
        yield head, body


def resolved(pages: DataFrame, min_bytes: int = 0, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, uri, html, sha1, refers_to, revisit) of each page: which one is a response and which revisits it. Only
    responses have an html, only revisits a sha1.

    Headers are written once, without payloads: ids, addresses, digests and sizes. Digests meet there, so revisits are
    known and come from their headers alone. All other pages are responses, and stay where they are read, but for a few
    (see line_dedup.without_keys()).
    """
    uri = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    pages = pages.select(F.col(key).cast("long").alias("page_id"), uri.alias("uri"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    pages = pages.withColumn("h", F.xxhash64("html"))
    size = F.octet_length("html")
    headers = written(pages.select("page_id", "uri", "h", F.when(size >= min_bytes, F.unhex(F.sha1("html"))).alias("sha1"), size.alias("size")))
    # A null id comes after all others.
    same = headers.where("sha1 IS NOT NULL")
    first = same.groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    revisits = same.join(first, ["sha1", "size"]).where(~F.col("page_id").eqNullSafe(F.col("first")))
    revisits = written(revisits.select("page_id", "uri", "h", "sha1", F.col("first").alias("refers_to")))
    # By id and a hash of the payload: rows that repeat an id with another payload are told apart.
    a, b = F.xxhash64("page_id", "h"), F.xxhash64("h", "page_id", F.lit(1))
    sure = without_keys(pages, revisits.select(a.alias("a"), b.alias("b")).distinct(), a, b, headers)
    none = {"sha1": F.lit(None).cast("binary"), "refers_to": F.lit(None).cast("long"), "revisit": F.lit(False)}
    columns = ["page_id", "uri", "html", "sha1", "refers_to", "revisit"]
    found = revisits.withColumns({"html": F.lit(None).cast("string"), "revisit": F.lit(True)})
    return sure.withColumns(none).select(*columns).unionByName(found.select(*columns))


def write_archives(pages: DataFrame, min_bytes: int = 0, key: str = "page_id", html: str = "html", level: int = 3) -> DataFrame:
    """Writes a record per page and returns the manifest (path, records, bytes), itself written.

    Equal payloads of at least min_bytes bytes: the one with the smallest key is the response, others revisit it;
    smaller ones are all responses. A null html is an empty payload; a null key comes after all others and is
    left out of the header; a null url too, or a table without that column. Rows that repeat the response's key and payload are responses too.
    An empty table writes no file. Other columns aren't written.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = f"{scratch(spark)}-warc"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        out, name, n, size, done = None, "", 0, 0, []
        for b in batches:
            for page_id, uri, text, sha1, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = gzip.compress(record(page_id, uri, (text or "").encode(), refers_to, revisit, sha1), level, mtime=0)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= FILE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        columns = zip(("path", "records", "bytes"), (pa.string(), pa.int64(), pa.int64()), strict=True)
        yield pa.RecordBatch.from_pydict({c: pa.array([x[k] for x in done], kind) for k, (c, kind) in enumerate(columns)})

    return written(resolved(pages, min_bytes, key, html).mapInArrow(run, MANIFEST))


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the manifest's files: RECORDS. payload and payload_bytes are null for revisits; digests are
    computed from the payload for responses and taken from the header for revisits. Without payloads, these are
    read and measured but not handed on."""
    spark = manifest.sparkSession
    kinds = spark.createDataFrame([], RECORDS).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kinds)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, path = opened(uri)
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for head, body in parsed(io.BufferedReader(stream, 1 << 20)):
                        revisit = head[b"WARC-Type"] == b"revisit"
                        page = head.get(b"WARC-Page-ID")
                        target = head.get(b"WARC-Target-URI")
                        rows.append((
                            head[b"WARC-Record-ID"].decode(), head[b"WARC-Type"].decode(), int(page) if page else None, from_line(target) if target is not None else None,
                            body if payloads and not revisit else None, None if revisit else len(body), head[b"WARC-Payload-Digest"][5:].decode() if revisit else digest(body),
                            head[b"WARC-Refers-To"].decode() if revisit else None,
                        ))
                        held += len(body)
                        if (payloads and held > 2 << 20) or len(rows) >= 1024:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return manifest.select("path").repartition(max(1, min(manifest.count(), 100_000))).mapInArrow(run, kinds)


def with_originals(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits joined to their originals; a revisit
    whose original isn't among the records has neither bytes nor a page that it refers to."""
    small = records.select("record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to_id")
    small = written(small)
    responses = small.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id"), "payload_digest")
    originals = responses.agg(F.min("page_id").alias("refers_to"), F.max("payload_bytes").alias("original_bytes"))
    revisits = small.where("record_type = 'revisit'").join(originals, ["refers_to_id", "payload_digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = revisits.select("page_id", F.col("original_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return small.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(found)
