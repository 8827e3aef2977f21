"""Ranked lexical search, hard negatives and packing under several limits against plain versions."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cairn.llm import binpack, lexical, negatives, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k):
    own = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n, total, df = len(own), sum(sum(c.values()) for _, c in own), Counter(x for _, c in own for x in c)
    w = {x: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for x, d in df.items()}
    out = []
    for item, text in items:
        terms, scored = TERM.findall((text or "").translate(UPPER)), []
        for i, c in own:
            m = 75 + (25 * sum(c.values()) * n) // total
            score = sum(w[x] * ((10**9 * c[x]) // (1000 * c[x] + 12 * m)) for x in terms if x in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [(4, 1 << 18), (1024, 6), (1024, 1 << 18)])
def test_lexical(spark, parts):
    rng = np.random.default_rng(5)
    words = ["alpha", "Été", "b2", "née", "x", "zeta9", "o'clock", "DO-RE", "größe"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "... !?"), (103, "x " * 3000), (7, docs[7][1]), (7, docs[7][1]), (None, "alpha b2 Alpha"), (None, "alpha b2 Alpha"), (104, "née\0née"), (105, "alpha b2 ALPHA")]
    items = [(1, "Alpha alpha née"), (2, None), (3, "unknown words"), (4, "..."), (5, "o'clock DO-RE größe x x x"), (6, "b2 alpha")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"m": F.lit("clash"), "term": F.lit(1), "s": F.lit(2)})
    index = lexical.build(d, part_docs=parts[0], part_postings=parts[1])
    assert index.parts.agg(F.sum(F.size("docs"))).first()[0] == index.n_docs
    for first in (1, 4):
        got = lexical.search(index, spark.createDataFrame(items, "item_id long, text string").withColumn("q", F.lit(0)), k=5, first=first, block=2)
        assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items, 5)
    none = lexical.build(d.limit(0))
    assert lexical.search(none, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert lexical.search(index, spark.createDataFrame(items, "item_id long, text string").limit(0)).count() == 0


def test_index_strata(spark):
    d = spark.createDataFrame([(i, "a " * (1 + i % 3) + "b") for i in range(30)], "doc_id long, text string")
    parts = lexical.build(d, part_docs=5).parts.collect()
    assert {p.m for p in parts} == {75 + 25 * n * 30 // 90 for n in (2, 3, 4)}
    for p in parts:
        assert list(p.run_tf) == sorted(p.run_tf[: len(p.run_tf) - 1], reverse=True) + [p.run_tf[-1]] or len(p.terms) == 2
        assert sum(p.dfs) == len(p.members) == sum(p.run_len)


def test_hilbert_neighbours():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = negatives.hilbert(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def mined(rows):
    good = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in rows if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, lab, v in good:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, u, strict=True)), i, own) for i, own, u in good if i != a and len(u) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == lab][:5]:
            near = [(s, i) for s, i, own in scored if own != lab and 80 * -ps <= 100 * -s <= 100 * -ps][:5]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 64])
def test_hard_negatives(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i * 5, int(rng.integers(0, 3)), [float(x) for x in rng.normal(0.2, 0.4, 6).astype(np.float32)]) for i in range(200)]
    rows += [(2000 + i, i % 3, rows[20][2]) for i in range(30)]  # ties
    rows += [(5, rows[1][1], rows[1][2])] * 2  # repeated rows
    rows += [(3000, None, [1.0] * 6), (3001, 1, None), (3002, 1, [1.0, None] + [0.0] * 4), (3003, 1, [float("nan")] * 6), (None, 1, [0.5] * 6), (3100, 0, [1.0, 2.0]), (3101, 0, [1.0, 2.0]), (3102, 1, [1.0, 1.9]), (3200, 1, []), (3201, 1, []), (3202, 2, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"block": F.lit("clash"), "w": F.lit(1), "v": F.lit(0)})
    got = negatives.mine(negatives.labelled(df), F.col("vec_id") % 100 == 0, block=block)
    assert sorted(map(tuple, got.collect())) == mined(rows)
    assert negatives.mine(negatives.labelled(df.limit(0)), F.col("vec_id") % 100 == 0).count() == 0


def test_zone_maps_keep_blocks_out(spark):
    """Of well parted clusters an anchor reads its own blocks only."""
    rng = np.random.default_rng(4)
    rows = [(i, 0, [float(x) for x in np.eye(4)[i % 4] * 9 + rng.normal(0, 0.05, 4)]) for i in range(400)]
    v = negatives.labelled(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).withColumn("rid", F.monotonically_increasing_id())
    table = negatives.blocks(v, size=20)
    spans = [(np.frombuffer(r.low, np.int64), np.frombuffer(r.high, np.int64)) for r in table.collect()]
    assert sum((hi - lo).max() < 1000 for lo, hi in spans) >= 0.75 * len(spans)
    assert table.agg(F.sum(F.length("ids") / 8)).first()[0] == 400


def test_products_of_large_numbers_are_exact():
    a = np.array([[2**30, -(2**30), 3]])
    assert negatives._products(a, np.array([[2**31, 2**30 + 1, 5]])).tolist() == [[2**61 - 2**60 - 2**30 + 15]]


def padding(rows, limits):
    """Padding of all sequences, after a look at their limits and places."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append(r)
    out = 0
    for own in held.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        tokens = sum(r.length for r in own)
        assert tokens <= limits.tokens and len(own) <= limits.segments and sum(r.loss for r in own) <= limits.loss
        out += 0 if tokens & (tokens - 1) == 0 else limits.tokens - tokens
    return out


def test_op13(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.queries()["op13_instruction_packing"](spark, SF).collect()
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(docs)
    for i, t in docs.items():
        ids, at = [*lib.encode(t or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(by[i], key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(part, "<u4").tobytes()))
            at += r.length
        assert at == len(ids)
    assert padding(rows, binpack.Limits()) == 0
    assert len(rows) < 1.2 * len(docs) + sum(r.length for r in rows) / 2048


def test_packing_of_conversations(spark):
    """Turns of the assistant bear loss; all three limits bind, and examples stay whole unless they are too long."""
    limits = binpack.Limits(tokens=512, segments=4, loss=160)
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    part = F.struct("turn", "text", (F.col("role") == "assistant").alias("loss"))
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("x")).select("conv_id", F.transform("x", lambda t: F.struct(t["text"].alias("text"), t["loss"].alias("loss"))).alias("parts"))
    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = spark.createDataFrame([(-1, None), (-2, []), (-3, [(None, True), ("x " * 3000, True)]), (-4, [("hi", None)]), (-4, [("hi", None)])], "conv_id long, parts array<struct<text string, loss boolean>>")
    table = binpack.pieces(talks.unionByName(odd), "conv_id", path, parts_col="parts", limits=limits)
    rows = binpack.pack(table, limits, cut=False).collect()
    padding(rows, limits)
    lib, want = Tokenizer.from_file(path), {}
    for r in talks.unionByName(odd).collect():
        own = [(len(lib.encode(p.text or "", add_special_tokens=False).ids) + 1, bool(p.loss)) for p in r.parts or []] or [(1, False)]
        want.setdefault(r.conv_id, Counter()).update(tokens=sum(n for n, _ in own), loss=sum(n for n, own_loss in own if own_loss))
    for i, w in want.items():
        own = [r for r in rows if r.doc_id == i]
        assert (sum(r.length for r in own), sum(r.loss for r in own)) == (w["tokens"], w["loss"])
    whole = [i for i, w in want.items() if i >= 0 and w["tokens"] <= limits.tokens and w["loss"] <= limits.loss]
    assert all(sum(r.doc_id == i for r in rows) == 1 for i in whole)
    least = max(sum(w["tokens"] for w in want.values()) / 512, sum(w["loss"] for w in want.values()) / 160, len(rows) / 4)
    assert len({r.sequence_id for r in rows}) <= 1.35 * least + 2
    assert binpack.pack(binpack.pieces(talks.limit(0), "conv_id", path, parts_col="parts", limits=limits), limits, cut=False).count() == 0


def test_plan_does_not_grow_with_the_corpus():
    lengths = np.minimum(2048, np.random.default_rng(0).lognormal(5.5, 1, 5000).astype(int) + 1)
    kinds, n = np.unique(binpack._class(lengths, lengths, binpack.Limits()), return_counts=True)
    for times in (1, 10**7):
        counts = dict(zip(kinds.tolist(), (n * times).tolist(), strict=True))
        rows, sequences = binpack.plan(counts)
        assert len(rows) < 30_000 and sequences <= lengths.sum() * times / 2048 * (1 + 1e-6) + 12
        assert rows[:, 3].min() > 0 and (rows[:, 5] + rows[:, 3]).max() <= 2048
