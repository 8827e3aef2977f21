"""Exact top-k search, WARC and TIFF against plain versions."""

import base64
import gzip
import hashlib
import io
import struct
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import queries, tiff, vafile, warc


def brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.setdefault(i, [int(np.floor(256 * float(np.float32(x)))) for x in v])
    out = []
    for q, a in good.items():
        if q % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good.items() if i != q and len(b) == len(a))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 8192])
def test_top_k(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 8).astype(np.float32)]) for i in range(300)]
    rows += [(300 + i, rows[i % 4][1]) for i in range(40)]  # ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [0.0] * 8), (550, [1.0, 2.0]), (551, [0.5, 0.5]), (600, []), (601, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    v = vafile.quantised(df)
    got = vafile.top_k(v, v.where("vec_id % 50 = 0"), 5, block=block, query_block=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)
    assert vafile.top_k(v.limit(0), v.limit(0)).count() == 0


def test_top_k_query_groups(spark):
    df = spark.createDataFrame([(i * 50, [float(i % 7), 1.0]) for i in range(40)], "vec_id long, embedding array<float>")
    v = vafile.quantised(df)
    assert sorted(map(tuple, vafile.top_k(v, v, 3, group=8).collect())) == sorted(map(tuple, vafile.top_k(v, v, 3).collect()))


def test_warc(spark, tmp_path):
    big = "<p>" + "é" * 70_000
    rows = [(1, "http://a/x y", "same"), (2, None, "same"), (5, "u", "same"), (3, "u", None), (4, "u", ""), (6, "u\r\nWARC/1.1", big), (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(warc.with_record_types(pages, "page_id", "html", "url"), "file://" + str(tmp_path / "w"), max_bytes=200)
    assert archives.count() > 1 and archives.agg(F.sum("n_records")).first()[0] == len(rows)
    chunks = warc.read_chunks(archives, chunk_bytes=1000).cache()
    assert chunks.where("record_id = '6'").count() == -(-len(big.encode()) // 1000)
    body = b"".join(bytes(r.data) for r in chunks.where("record_id = '6'").orderBy("chunk").collect())
    assert body == big.encode()
    got = {r.record_id: r for r in warc.records(chunks).collect()}
    for i, _, html in rows:
        raw = (html or "").encode()
        r = got[None if i is None else str(i)]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
    assert [(got[k].record_type, got[k].refers_to) for k in ("1", "2", "5", "3", "4", "6", None)] == [("revisit", "5"), ("revisit", "5"), ("response", None), ("revisit", "4"), ("response", None), ("response", None), ("revisit", "5")]
    typed = warc.with_record_types(pages, "page_id", "html", min_bytes=5)
    assert typed.where("record_type = 'revisit'").count() == 0
    assert warc.records(warc.read_chunks(warc.write_archives(warc.with_record_types(pages.limit(0), "page_id", "html")))).count() == 0


def test_foreign_warc_records():
    """Heads are read within bounds; a block without an HTTP head is payload as a whole."""

    def record(kind, block):
        return b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:1>\r\nContent-Type: " + kind + b"\r\nContent-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    long = b"x" * (3 * warc.HEAD_BYTES + 5)
    head = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
    http = b"application/http; msgtype=response"
    cases = [(b"text/plain", b"one\r\n\r\ntwo", b"one\r\n\r\ntwo"), (b"text/plain", long, long), (http, head + long, long), (http, head, b""), (http, b"no head\r\n\r\nbody", b"no head\r\n\r\nbody"), (http, long, long), (b"text/plain", b"", b""), (http, b"HTTP/1.1 200 OK\r\n" + long, long)]
    data = gzip.compress(b"".join(record(kind, block) for kind, block, _ in cases))
    for size in (7, 1000, 1 << 20):
        found = {}
        n = -1
        for row in warc._chunks_of(gzip.GzipFile(fileobj=io.BytesIO(data)), size):
            n += row[4] == 0
            assert len(row[5]) <= size
            found[n] = found.get(n, b"") + row[5]
        assert [found[i] for i in range(len(cases))] == [want for _, _, want in cases]
    with pytest.raises(ValueError):
        list(warc._chunks_of(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(b"WARC/1.1\r\nA: " + long))), 10))


IMAGE = np.random.default_rng(3).integers(0, 4, (70, 33), np.uint8) * 60


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.LZW, tiff.ADOBE_DEFLATE, tiff.OLD_DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("layout", [{"rows_per_strip": 9}, {"tile": (16, 32)}])
def test_tiff_round_trip(compression, predictor, layout):
    pages = [IMAGE, IMAGE[:1, :5], np.full((40, 64), 7, np.uint8)]
    back = list(tiff.decode(tiff.encode(pages, compression, predictor, **layout)))
    assert [b[:, :, 0].tolist() for b in back] == [p.tolist() for p in pages]


def test_lzw_long():
    for data in (bytes(np.random.default_rng(0).integers(0, 256, 60_000, np.uint8)), b"ab" * 40_000, b"", b"x"):
        assert tiff.lzw_decode(tiff.lzw_encode(data)) == data
        assert tiff.unpack_bits(tiff.pack_bits(data)) == data


def test_tiff_big_endian():
    tags = [(256, 4, 2), (257, 4, 1), (258, 3, 8 << 16), (259, 3, 1 << 16), (273, 4, 8), (277, 3, 1 << 16), (278, 4, 1), (279, 4, 2)]
    head = struct.pack(">2sHI", b"MM", 42, 10) + b"\x05\x09"
    body = struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", t, k, 1, v) for t, k, v in tags) + struct.pack(">I", 0)
    assert [x[:, :, 0].tolist() for x in tiff.decode(head + body)] == [[[5, 9]]]


def test_media_table(spark):
    rows = [(1, "héllo " * 40), (2, None), (3, ""), (3, ""), (4, "x" * 64)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", F.lit(1))
    got = sorted((r.id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in tiff.with_features(tiff.pages(tiff.to_tiff(df, "doc_id", "text", predictor=2, rows_per_strip=1))).collect())
    want = []
    for i, t in rows:
        raw = (t or "").encode()
        pad = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        want.append((i, len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:])))
    assert got == sorted(want)
    two = spark.createDataFrame([(1, 0, bytearray(tiff.encode([IMAGE, IMAGE[:2]]))), (2, 0, None)], "id long, n_bytes long, media binary")
    assert [(r.page, r.width, r.height) for r in tiff.pages(two).orderBy("page").collect()] == [(0, 33, 70), (1, 33, 2)]


@pytest.mark.parametrize("block", [4, 8192])
def test_top_k_repeated_rows(spark, block, tmp_path):
    rows = [(0, [1.0, 0.0])] + [(1, [9.0, 0.0])] * 3 + [(1, [8.0, 1.0]), (2, [8.0, 0.0])] + [(i, [10.0 - i, 0.5]) for i in range(3, 9)] + [(50, [1.0, 1.0]), (50, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    df.write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    v = vafile.quantised(df)
    got = vafile.top_k(v, v.where("vec_id % 50 = 0"), 5, block=block)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(queries.OP1_SQL).fetchall())


def test_features_of_nothing(spark):
    df = spark.createDataFrame([(1, 0, 0, None, None), (None, None, None, bytearray(b"ab"), bytearray(b"x"))], "id long, n_bytes long, page int, pixels binary, media binary")
    out = sorted(tiff.with_features(df).collect(), key=lambda r: r.payload_bytes)
    assert [(r.payload_bytes, r.media_bytes, r.feature) for r in out] == [(0, 0, "0:0:0:0"), (2, 1, "195:19013:1:2")]
