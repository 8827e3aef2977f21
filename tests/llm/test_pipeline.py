"""The pipeline's stages on the smallest tables."""

import hashlib
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from cairn.llm import minhash, pii, queries
from pyspark.sql import functions as F
from test_dedup import Groups, shingles
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        docs, earlier = spark.read.parquet(str(tmp_path / str(k))), docs
        if name == "packing":
            assert {"doc_id", "sequence_id", "offset"} <= set(docs.columns)
            assert docs.select("doc_id").distinct().count() == before
            continue
        assert docs.columns == columns
        after = docs.count()
        assert after <= before and (name in ("quality", "near-duplicates") or after == before)
        if name == "quality":
            scores = queries.op10_quality(spark, SF)
            assert docs.join(scores.where("predicted = 0"), "doc_id").count() == 0
        if name == "near-duplicates":
            assert minhash.near_duplicates(docs).where("NOT kept").count() == 0
            assert earlier.join(docs, "doc_id", "left_anti").count() == before - after
        if name == "pii":
            left = pii.with_spans(pii.with_candidates(docs), pii.Selector(pii.quality.fit(pii.np.empty((0, 8)), pii.np.empty(0)), {}))
            assert left.where(F.size("pii_base") > 0).count() == 0
        before = after


def test_near_duplicates_by_row(spark):
    a, b, c, d = ("".join(f"{w}{i} " for i in range(30)) for w in "abcd")
    rows = [(1, a), (2, a + "x"), (2, b), (3, c), (3, c), (4, a), (4, a), (5, c), (None, d), (None, d), (None, d + "x"), (None, b), (6, ""), (7, ""), (7, ""), (8, None), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(x.doc_id, x.text) for x in corpus_pipeline.dedup_documents(spark, docs, SF).collect()]
    # Of d and d + "x", both without an id, either stays.
    assert sum(i is None and (t or "").startswith(d) for i, t in got) == 1
    rest = sorted((x for x in got if not (x[1] or "").startswith(d)), key=str)
    assert rest == sorted([(1, a), (2, b), (3, c), (6, ""), (7, ""), (8, None), (None, None)], key=str)


def test_stages_with_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns that clash with names used inside."""
    long_ = "the quick brown fox " * 6000
    rows = [(1, None, None, None, None), (None, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "some words a@b.cd here", "en", None, 3), (3, long_, "en", "a", 9), (4, long_, None, "a", 9), (4, long_, None, "a", 9), (5, " \n ", "en", "b", 1), (None, "x y", "en", "b", 3), (None, "x y", "en", "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = docs.withColumns({c: F.lit("clash") for c in ("score", "node", "th", "key", "pii_all", "pii_half", "n_lines_removed", "rid", "length", "i")})
    for name, stage in corpus_pipeline.STAGES:
        out, wide, none = (stage(spark, d, SF) for d in (docs, clash, docs.limit(0)))
        assert none.count() == 0
        assert sorted(out.columns) == sorted(wide.columns) == sorted(none.columns)
        got = sorted(map(str, (r.asDict() for r in out.drop("sequence_id", "offset").collect())))
        assert got == sorted(map(str, (r.asDict() for r in wide.drop("sequence_id", "offset").collect()))), name
        if name == "quality":
            continue  # which of these are good enough is the model's matter
        if name == "lines":
            assert out.count() == len(rows)
            assert [r.text for r in out.where("doc_id IS NULL").orderBy("text").collect()] == [None, "some words a@b.cd here", "x y", "x y"]
            assert [r.text for r in out.where("doc_id IN (3, 4)").orderBy("doc_id").collect()] == [long_, "", ""]
        if name == "near-duplicates":
            assert out.where("doc_id = 3").count() == 1 and out.where("doc_id = 4").count() == 0 and out.where("doc_id = 2").count() == 1
        if name == "pii":
            assert out.count() == len(rows) and out.where("text LIKE '%a@b.cd%'").count() == 0
            assert out.where("text = 'some words [EMAIL] here' AND n_chars = 23").count() == 1
        if name == "packing":
            assert out.where("piece = 0").count() == len(rows)


def line_groups(rows):
    """Texts without lines that are similar (ten characters, 0.8) to an earlier line, by comparing all lines."""
    places = [(i, k, x) for i, t in sorted(rows) for k, x in enumerate((t or "").split("\n")) if x.strip(" ")]
    norms = sorted({x.strip(" ").lower() for *_, x in places}, key=len)
    sets = [{x[p : p + 10] for p in range(max(1, len(x) - 9))} for x in norms]
    g = Groups()
    for i, a in enumerate(sets):
        for j in range(i - 1, -1, -1):
            b = sets[j]
            if len(norms[j]) < 0.5 * len(norms[i]) - 20:
                break
            if 10 * min(len(a), len(b)) >= 8 * max(len(a), len(b)) and 100 * (both := len(a & b)) >= 80 * (len(a) + len(b) - both):
                g.join(i, j)
    number, first, gone = {x: i for i, x in enumerate(norms)}, {}, set()
    for i, k, x in places:
        if first.setdefault(g.root(number[x.strip(" ").lower()]), (i, k)) != (i, k):
            gone.add((i, k))
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_lines_of_the_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = line_groups(rows)
    got = {r.doc_id: (r.n_lines_removed, r.n_chars, r.kept_sha256) for r in queries.op8_lines(spark, SF).collect()}
    before = {i: len((t or "").split("\n")) for i, t in rows}
    for i, t in want.items():
        lost = before[i] - len((t or "").split("\n")) + (t == "" and before[i] > 0 and bool(dict(rows)[i]))
        assert got[i] == (lost, len(t or ""), hashlib.sha256((t or "").encode()).hexdigest())


def test_run_is_the_stages_by_hand(spark):
    """The rows of run() against plain versions of its stages; the scores and added spans are those of the queries."""
    kept = {r.doc_id for r in queries.op10_quality(spark, SF).where("predicted = 1").collect()}
    now = line_groups([(i, t) for i, t in texts(spark.read.parquet(f"{SF}/documents.parquet")).items() if i in kept])
    sets = {i: shingles(t, 5) for i, t in now.items()}
    g = Groups()
    for i, a in sorted(sets.items()):
        for j, b in sorted(sets.items()):
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                g.join(i, j)
    least = {}
    for i in sorted(now):
        least.setdefault(g.root(i), i)
    now = {i: t for i, t in now.items() if not sets[i] or least[g.root(i)] == i}
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in now.items()], "doc_id long, text string, lang string, source string, n_chars long")
    now = texts(corpus_pipeline.redact(spark, docs, SF))
    lib, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, t in now.items():
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, at, len(part := ids[at : at + 2048]), zlib.crc32(np.array(part, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append(r)
    for own in held.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and sum(r.length for r in own) <= 2048
