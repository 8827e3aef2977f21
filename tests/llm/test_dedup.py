"""Repeats, near-duplicates and fuzzy lines against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cairn.llm import common, graph, lines, minhash, passages, suffix


class Groups:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.parent[b] = a


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(5001, 5400)] + [(7, 7), (None, 3)]
    g = Groups()
    for a, b in links:
        if a is not None and a != b:
            g.join(a, b)
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {x: g.root(x) for x in list(g.parent)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[p : p + length] for _, r in raws for p in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = sum(1 for j in range(len(r)) if gone[j] and not (j and gone[j - 1]))
        out.append((str(i), len(r), sum(gone), runs, hashlib.sha256(bytes(x for x, k in zip(r, gone, strict=True) if not k)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("segment", [700, suffix.SEGMENT])
def test_repeats(spark, segment):
    r = random.Random(4)
    make = lambda n, a="abcdefgh ": "".join(r.choice(a) for _ in range(n))
    base = [make(3000) for _ in range(3)]
    rows = []
    for i in range(50):
        t = make(r.randrange(600))
        for _ in range(r.randrange(3)):
            b, s = r.choice(base), r.randrange(2000)
            t += b[s : s + r.choice([390, 399, 400, 401, 450, 700, 1000])] + make(r.randrange(90), "xyz")
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "é" * 300), (103, "é" * 300), (104, "a" * 1500), (105, "ab" * 700), (106, base[0]), (106, base[0]), (107, "q" * 399), (108, base[1][:1200] + "!" + base[1][1201:]), (None, base[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("raw", F.lit("clash"))
    got = sorted((str(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix.without_repeats(df, segment=segment).collect())
    assert got == removed(rows, 400)
    assert suffix.without_repeats(df.limit(0)).count() == 0


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("block", [None, 16])
def test_near_duplicates(spark, block, monkeypatch):
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(12):
        base = [r.choice(vocab) for _ in range(r.choice([3, 5, 9, 40, 120, 300]))]
        for _ in range(r.choice([1, 3, 30])):
            t = list(base)
            for _ in range(r.randrange(1 + len(t) // 25)):
                t[r.randrange(len(t))] = r.choice(vocab)
            rows.append((n, " ".join(t).title() if n % 3 else "\t".join(t)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "Éa é"), (n + 3, "Éa é"), (None, rows[0][1])]
    if block:
        monkeypatch.setattr(minhash, "BLOCK", block)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = sorted(map(tuple, minhash.near_duplicates(df, words=4, percent=80).where("doc_id IS NOT NULL").collect()))
    sets, g = [shingles(t, 4) for _, t in rows], Groups()
    for i, a in enumerate(sets):
        g.root(i)
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                g.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[g.root(i)] = min(least.get(g.root(i), d), d)
    want = sorted((d, len(sets[i]), least[g.root(i)], d == least[g.root(i)]) for i, (d, _) in enumerate(rows) if d is not None)
    assert got == want
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_small_documents_with_a_common_passage(spark, monkeypatch):
    """A passage that unlike short documents share makes no family of them all; near copies are still found."""
    r = random.Random(8)
    common_words = " ".join(f"p{i}" for i in range(16))
    rows = [(n, f"{common_words} " + " ".join(f"w{r.randrange(10**6)}" for _ in range(r.randrange(20, 40)))) for n in range(200)]
    rows += [(1000 + n, f"{t} more") for n, t in rows[:20]]
    seen, links = [], minhash.links

    def counted(sets, percent):
        seen.append([x["count"] for x in sets.groupBy("family").count().collect()])
        return links(sets, percent)

    monkeypatch.setattr(minhash, "links", counted)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4, percent=80)
    assert {x.doc_id: x.component_id for x in found.collect()} == {n: n % 1000 for n, _ in rows}
    assert sorted(seen[0]) == [2] * 20


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, -1])
def test_lines(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))
    pool = [[word() for _ in range(60)] for _ in range(8)]
    rows = []
    for i in range(40):
        own = []
        for _ in range(r.randrange(1, 5)):
            line = list(r.choice(pool)) if r.random() < 0.6 else [word() for _ in range(30)]
            if r.random() < 0.5:
                line[r.randrange(len(line))] = word()
            own.append(" ".join(line))
        rows.append((i, "\n".join(own) + ("\n\n" if i % 5 == 0 else "")))
    rows += [(90, None), (91, ""), (92, "\n"), (93, "Short."), (94, " short. \nother"), (94, " short. \nother"), (95, "z" * 5000), (96, "abcdefghij" + "k" * 50), (97, "abcdefghij" + "lmn" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines_removed", F.lit("clash")).withColumn("doc", F.lit(1))
    got = {x.doc_id: (x.text, x.n_lines_removed) for x in lines.without_repeated_lines(df).collect()}
    g, places = Groups(), []
    for i, t in dict(rows).items():
        for k, line in enumerate((t or "").split("\n")):
            norm = line.strip(" ").lower()
            if norm:
                places.append((i, k, norm))
    sets = {n: {n[p : p + 10] for p in range(max(1, len(n) - 9))} for _, _, n in places}
    names = list(sets)
    for a in range(len(names)):
        g.root(names[a])
        for b in range(a):
            x, y = sets[names[a]], sets[names[b]]
            if 100 * len(x & y) >= 80 * len(x | y):
                g.join(names[a], names[b])
    first = {}
    for i, k, n in sorted(places):
        first.setdefault(g.root(n), (i, k))
    for i, t in dict(rows).items():
        if t is None:
            assert got[i] == (None, 0)
            continue
        norms = {k: n for j, k, n in places if j == i}
        kept = [x for k, x in enumerate(t.split("\n")) if k not in norms or first[g.root(norms[k])] == (i, k)]
        assert got[i] == ("\n".join(kept), len(t.split("\n")) - len(kept))
    assert lines.without_repeated_lines(df.limit(0)).count() == 0


def test_lines_shingle_every_character(spark):
    r = random.Random(8)
    make = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    rows = []
    for k in range(20):
        token = make(200)
        # One more character in front moves all that follows; 16 changed ones in small gaps leave few strings as they were.
        rows += [(10 * k, token), (10 * k + 1, "X" + token), (10 * k + 2, "\U0001f600 é" * 4 + token), (10 * k + 3, token[:100])]
        rows += [(10 * k + 4, " ".join(token[i : i + 12] for i in range(0, 200, 12))), (10 * k + 5, " ".join(token[i : i + 11] + "q" for i in range(0, 200, 12)))]
    sets = {i: {t.lower()[p : p + 10] for p in range(len(t) - 9)} for i, t in rows}
    g = Groups()
    for i, a in sets.items():
        g.root(i)
        for j, b in sets.items():
            if j < i and 100 * len(a & b) >= 80 * len(a | b):
                g.join(i, j)
    got = {x.doc_id: x.n_lines_removed for x in lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(g.root(i) != i) for i in sets}
    assert sum(got.values()) >= 20


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, -1])
def test_shared_passages(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(passages, "SLICE", 40)
    r = random.Random(10)
    make = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    pool = [make(n) for n in (10, 19, 20, 21, 25, 60)]
    rows = []
    for i in range(120):
        t = make(r.choice([0, 5, 30, 90]))
        for _ in range(r.randrange(3)):
            t += r.choice(pool) + make(r.choice([0, 1, 30]))
        rows.append((i, (" " if i % 2 else "\n").join(t)))
    rows += [(200, None), (201, ""), (202, rows[3][1]), (202, rows[3][1]), (None, " ".join(pool[3])), (None, " ".join(pool[3]) + " x"), (203, "a " * 50), (204, " ".join(pool[5] * 3))]
    words, docs = 20, {}
    for i, t in rows:
        raw, spans = (t or "").encode(), [m.span() for m in re.finditer(rb"\S+", (t or "").encode())]
        docs[i, t or ""] = {raw[spans[k][0] : spans[k + words - 1][1]] for k in range(len(spans) - words + 1)}
    many = Counter(w for own in docs.values() for w in own)
    want = [k for k, own in docs.items() if any(many[w] > 1 for w in own)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = suffix.rows_of(df)
    got = passages.sharing(held, words, 8).join(held, ["rid", "th"]).select("rid", F.decode("raw", "UTF-8").alias("t")).distinct().collect()
    none = -(1 << 63)
    assert sorted((x.rid, x.t) for x in got) == sorted((none if i is None else i, t) for i, t in want)


def test_shingle_sets():
    norms = ["", "abc", "abcdefghij", "abcdefghijk", "aaaaaaaaaaaaaaa", "é\U0001f600" * 20, "abc"]
    for width in (1, 3, 10):
        keys, n = lines.shingle_sets(norms, width)
        assert n.tolist() == [len({x[p : p + width] for p in range(max(1, len(x) - width + 1))}) for x in norms]
        assert (np.diff(keys.astype(float)) >= 0).all() and len(keys) == n.sum()
    assert lines.shingle_sets([], 10)[1].tolist() == []


def test_sketches_keep_similar_lines():
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    pairs = []
    for _ in range(800):
        t = [r.choice(vocab) for _ in range(r.choice([5, 20, 70, 200]))]
        u = [r.choice(vocab) if r.random() < 0.06 else w for w in t]
        pairs.append((" ".join(t), " ".join(u)))
    (n, a), (m, b) = (lines.sketches([p[k] for p in pairs], 10) for k in (0, 1))
    near = 0
    for k, (x, y) in enumerate(pairs):
        x, y = ({z[p : p + 10] for p in range(max(1, len(z) - 9))} for z in (x, y))
        assert (len(x), len(y)) == (n[k], m[k])
        if 100 * len(x & y) >= 80 * len(x | y):
            near += 1
            assert sum(bin(int(v) & (2**64 - 1)).count("1") for v in a[k] ^ b[k]) <= 46
    assert near > 200


def test_line_hash_is_sparks(spark):
    rows = [("",), (" ",), ("é\U0001f600 x" * 9,), ("x" * 100,)]
    got = spark.createDataFrame(rows, "line string").select(F.xxhash64("line").alias("h"), "line").collect()
    assert [x.h & (2**64 - 1) for x in got] == [xxhash.xxh64_intdigest(x.line.encode(), 42) for x in got]


def test_short_lines_are_all_linked(spark):
    r = random.Random(9)
    make = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    # 45 strings of ten characters each, 40 of them in both: a similarity of exactly 0.8.
    rows = [(k, f"{t}{make(4)}y\n{t}{make(4)}z") for k, t in enumerate(make(49) for _ in range(3000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines.linked(lines.buckets(docs), lines.lines_of(docs, "doc_id", "text").select("node", "line").distinct())
    assert found.count() == 6000
    assert found.select("component").distinct().count() == 3000


def test_large_sketches_are_not_broadcast(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lines, "staged", lambda df, tag: seen.append((tag, df._jdf.queryExecution().optimizedPlan().toString())) or common.staged(df, tag))
    docs = spark.createDataFrame([(k, f"one line of the text {k // 2} that is much like the other{'s' * (k % 2)}") for k in range(40)], "doc_id long, text string")
    for most, hints in ((common.BROADCAST_BYTES, 1), (0, 0)):
        monkeypatch.setattr(lines, "SKETCH_BYTES", most, raising=False)
        seen.clear()
        found = lines.linked(lines.buckets(docs), lines.lines_of(docs, "doc_id", "text").select("node", "line").distinct())
        assert found.count() == 40
        assert [plan.count("strategy=broadcast") for tag, plan in seen if tag == "line-members"] == [hints]
