"""WARC archives and the chunked record table.

Archives are written with one gzip member per record. They are read as a stream:
a record's payload never stands whole in memory but becomes rows of record id and
chunk number, each with the bytes and the SHA-1 digest of the payload so far, so
that the last chunk of a record carries its size and its digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, new_path, staged

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

_CHUNKS = "record_id string, record_type string, refers_to string, uri string, chunk int, data binary, bytes_so_far long, sha1_so_far string, is_last boolean, declared_bytes long, declared_digest string"
#: A line of a head may have so many bytes; what is longer is no head.
HEAD_BYTES = 1 << 16


def with_record_types(pages: DataFrame, id_col: str, payload_col: str, uri_col: str | None = None, min_bytes: int = 0) -> DataFrame:
    """``record_id, record_type, refers_to, uri, payload, sha1``, one row per input row.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the
    largest id is the response, the others are revisits of it; shorter payloads are
    all responses. A null payload is empty. Repeated rows of the response's id are
    responses too; rows without an id revisit, or are responses where no row of
    their payload has an id.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), (F.col(uri_col) if uri_col else F.lit(None).cast("string")).alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    again = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(broadcast_if_small(staged(again, "repeated-payloads")), "sha1", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    return joined.select(
        F.col("id").cast("string").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper").cast("string")).alias("refers_to"),
        "uri", "payload", "sha1",
    )


def _record(record_id: str, kind: str, refers_to: str | None, uri: str | None, payload: bytes, sha1: str) -> Iterator[bytes]:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:record:{record_id}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", HTTP_TYPE)]
    if uri:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)))
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:record:{refers_to}>"), ("X-Payload-Length", str(len(payload)))]
        payload = b""
    head.append(("Content-Length", str(len(http) + len(payload))))
    yield VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + http
    for at in range(0, len(payload), 1 << 20):
        yield payload[at : at + (1 << 20)]
    yield b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str | None = None, max_bytes: int = 64 << 20, level: int = 1) -> DataFrame:
    """Write records to archives of about ``max_bytes``; returns ``path, n_records, n_bytes``.

    ``records`` is what ``with_record_types`` returns. ``folder`` must be one that all
    executors share; by default it is a new one in the shared folder. Every task
    attempt writes files of its own, and only those of successful attempts are in the
    returned table, so a lost executor leaves no half archive in the result.
    """
    folder = folder or new_path(records.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, path, n, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": pa.array([f"{folder}/{path}"]), "n_records": pa.array([n], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

        for b in batches:
            for row in zip(*(b.column(c) for c in ("record_id", "record_type", "refers_to", "uri", "payload", "sha1")), strict=True):
                if out is None:
                    path, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{path}")
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                for part in _record(*(x.as_py() for x in row)):
                    data = z.compress(part)
                    size += len(data)
                    out.write(data)
                data = z.flush()
                size += len(data)
                out.write(data)
                n += 1
                if size >= max_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return staged(records.select("record_id", "record_type", "refers_to", "uri", "payload", "sha1").mapInArrow(run, "path string, n_records long, n_bytes long"), "archives")


def _header(stream: gzip.GzipFile) -> dict[str, str]:
    out = {}
    while (line := stream.readline(HEAD_BYTES)) not in (b"\r\n", b"\n", b""):
        if len(line) == HEAD_BYTES:
            raise ValueError("a line of a record's head is too long")
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _urn(value: str | None) -> str | None:
    found = value and value.strip("<>").removeprefix("urn:record:")
    return None if found in (None, "None") else found


def read_chunks(archives: DataFrame, chunk_bytes: int = 1 << 20, path_col: str = "path") -> DataFrame:
    """The chunked record table of gzipped archives.

    One row per chunk of at most ``chunk_bytes`` payload bytes; a record without
    payload has one empty chunk. The payload of an HTTP response is what follows its
    head; other records, and blocks that do not begin like a head, are payload from their
    first byte on. No line is read beyond HEAD_BYTES. ``declared_*`` are the header's size and digest of
    the payload; a response whose digest differs raises. A task reads one archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 4 + [pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in _CHUNKS.split(", ")]
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, path = FileSystem.from_uri(uri)
                held, size = [], 0
                with fs.open_input_stream(path) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for row in _chunks_of(stream, chunk_bytes):
                        held.append(row)
                        size += len(row[5])
                        if size >= chunk_bytes or len(held) >= 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)

    n = archives.count()
    return archives.select(path_col).repartition(max(1, n)).mapInArrow(run, _CHUNKS)


def _without_http_head(stream: gzip.GzipFile, length: int) -> tuple[bytes, int]:
    """Skip the HTTP head of a block of so many bytes: bytes already read that belong to the payload, and how many are left behind them."""
    first = stream.readline(min(HEAD_BYTES, length))
    if not first.startswith(b"HTTP/") or not first.endswith(b"\n"):
        return first, length - len(first)
    left = length - len(first)
    while left:
        line = stream.readline(min(HEAD_BYTES, left))
        left -= len(line)
        if line in (b"\r\n", b"\n"):
            break
        if not line.endswith(b"\n"):
            return line, left
    return b"", left


def _chunks_of(stream: gzip.GzipFile, chunk_bytes: int) -> Iterator[tuple]:
    while line := stream.readline(HEAD_BYTES):
        if line.strip() != VERSION:
            if line.strip():
                raise ValueError("not a WARC record")
            continue
        head = _header(stream)
        left = int(head["content-length"])
        held = b""
        if head.get("content-type", "").startswith("application/http"):
            held, left = _without_http_head(stream, left)
        kind, digest = head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha1:")
        own = (_urn(head.get("warc-record-id")), kind, _urn(head.get("warc-refers-to")), head.get("warc-target-uri"))
        declared = int(head.get("x-payload-length", left + len(held)))
        sha, so_far, k = hashlib.sha1(), 0, 0
        while True:
            data, held = held[:chunk_bytes], held[chunk_bytes:]
            more = stream.read(min(chunk_bytes - len(data), left)) if left and len(data) < chunk_bytes else b""
            if left and len(data) < chunk_bytes and not more:
                raise ValueError("the archive ends within a record")
            left -= len(more)
            data += more
            so_far += len(data)
            sha.update(data)
            last = not left and not held
            yield (*own, k, data, so_far, sha.hexdigest(), last, declared, digest)
            k += 1
            if last:
                break
        if kind == "response" and digest and base64.b32encode(sha.digest()).decode() != digest:
            raise ValueError(f"digest of record {own[0]} differs")


def records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk: ``record_id, record_type, refers_to, payload_bytes, payload_digest``."""
    return chunks.where("is_last").select(
        "record_id", "record_type", "refers_to",
        F.when(F.col("record_type") == "revisit", F.col("declared_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.col("declared_digest").alias("payload_digest"),
    )
