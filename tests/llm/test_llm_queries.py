"""The registered queries over the smallest tables, against SQL or plain versions."""

import hashlib
import math
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_dedup import Groups, removed, shingles
from test_texts import base_spans
from tokenizers import Tokenizer

from cairn.llm import queries

SF = "/root/testdata/sf0.001"
Q = queries.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    df = Q[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, cur.fetchall()))


def types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def test_op2(spark, docs):
    df = Q["op2_pii"](spark, SF)
    assert types(df) == {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string", "n_spans": "bigint"}
    got = {r.doc_id: r for r in df.collect()}
    for i, t in docs:
        base = base_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [base.count(f"{k}:") for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, base.split(","))) <= set(got[i].spans.split(","))
        assert got[i].n_spans == len(list(filter(None, got[i].spans.split(","))))


def test_op3(spark, docs):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: tuple(r) for r in Q["op3_bpe"](spark, SF).collect()}
    for i, t in docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_op5(spark, docs):
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in Q["op5_repeats"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == removed(docs, 400)


def test_op6(spark, docs):
    sets, g = {i: shingles(t, 4) for i, t in docs}, Groups()
    for i, a in sets.items():
        g.root(i)
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                g.join(i, j)
    want = sorted((i, len(a), g.root(i), g.root(i) == i) for i, a in sets.items())
    assert sorted(map(tuple, Q["op6_minhash"](spark, SF).collect())) == want


def test_op7(spark, docs):
    got = {r.doc_id: r for r in Q["op7_tiff"](spark, SF).collect()}
    for i, t in docs:
        raw = (t or "").encode()
        pad = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256, got[i].tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))


def test_op9(spark, docs):
    df = Q["op9_packing"](spark, SF)
    assert types(df) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    lib, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, t in docs:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, at, len(part := ids[at : at + 2048]), zlib.crc32(np.array(part, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    rows = df.collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= math.ceil(total / 2048) * 1.06 + 1


def test_op8_and_op10(spark, docs):
    lines = Q["op8_lines"](spark, SF)
    assert lines.count() == len(docs) and lines.where("n_lines_removed > 0").count() > 0
    df = Q["op10_quality"](spark, SF)
    assert types(df) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    for r in df.collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
