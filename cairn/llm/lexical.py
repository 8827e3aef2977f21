"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length alone, so the documents of one m are a
stratum, in which a term's impact is a function of tf only.

1. Texts become a forward table (document, length, different terms, tf of each), which
   gives the number of documents and terms, and with them each document's m.
2. A stratum is cut into parts of bounded size; a frequent m has many. A part is one row
   of the index: its documents, its terms with their largest tf, and each term's
   postings as runs of equal tf, largest first.
3. Bounds: an item's score in a part is at most the sum of its terms' weights times their
   impact at the largest tf. Only terms and largest tf are read for that.
4. Each item visits its parts with the highest bounds first. Its k-th best score there is
   a limit; of the other parts it visits those whose bound reaches the limit, and skips
   the rest. In a visited part the impact of a run is computed once for all its documents
   and all items.

The index holds all terms of all documents; items only say what is read from it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, staged

#: Bytes that are no part of a term; all others are, those of characters beyond ASCII included.
_BREAKS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_LOWER = bytes.maketrans(_BREAKS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_BREAKS) + b"abcdefghijklmnopqrstuvwxyz")
_FORWARD = "id long, n long, terms array<string>, tfs array<int>"
_PART = "m long, s int, docs array<long>, terms array<string>, most array<int>, dfs array<int>, run_tf array<int>, run_len array<int>, members array<int>"
_ARROW = pa.schema([("m", pa.int64()), ("s", pa.int32()), ("docs", pa.list_(pa.int64())), ("terms", pa.list_(pa.string()))] + [(c, pa.list_(pa.int32())) for c in ("most", "dfs", "run_tf", "run_len", "members")])


@dataclass(frozen=True)
class Index:
    """``parts`` is a written table with the columns of _PART; the totals are those of all documents with a term."""

    parts: DataFrame
    n_docs: int
    n_terms: int


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, ns, terms, tfs = [], [], [], []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if text and (words := text.translate(_LOWER).split()):
                counts = Counter(words)
                ids.append(i)
                ns.append(len(words))
                terms.append(list(counts))
                tfs.append(list(counts.values()))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int32()))], ["id", "n", "terms", "tfs"])


def forward(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rid, id, n, terms, tfs``: each text's length in terms, its different terms and how often each occurs.

    Terms are maximal stretches of digits, letters and characters beyond ASCII; only A-Z
    are lower-cased. Texts that are null or hold no term give no row. The table is
    written, and rid numbers its rows.
    """
    each = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(_forward, _FORWARD)
    return staged(each.select(F.monotonically_increasing_id().alias("rid"), "*"), "forward")


def _build(group: pa.Table) -> pa.Table:
    """One part: postings by term, then by tf from the largest."""
    lists = group.column("terms").combine_chunks()
    words = lists.flatten().dictionary_encode()
    code = words.indices.to_numpy(zero_copy_only=False)
    tf = group.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(group), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    order = np.lexsort((-tf, code))
    code, tf, doc = code[order], tf[order], doc[order]
    run = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])]))
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    n = len(words.dictionary)
    row = {"m": group.column("m")[0].as_py(), "s": group.column("s")[0].as_py(), "docs": group.column("id").combine_chunks(), "terms": words.dictionary, "most": tf[first], "dfs": np.bincount(code, minlength=n), "run_tf": tf[run], "run_len": np.diff(np.append(run, len(code))), "members": doc}
    columns = [pa.array([row[f.name]], f.type) if f.name in ("m", "s") else pa.ListArray.from_arrays([0, len(row[f.name])], pa.array(row[f.name], f.type.value_type)) for f in _ARROW]
    return pa.Table.from_arrays(columns, schema=_ARROW)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_docs: int = 1024, part_postings: int = 1 << 18) -> Index:
    """The index of all documents with a term, all their terms in it.

    Every row is a document, rows with repeated or null ids too. A part has about
    ``part_docs`` documents and ``part_postings`` postings at most, unless one document
    alone has more. The product 25 * length * documents must fit a long.
    """
    table = forward(docs, id_col, text_col)
    total = table.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    m = F.expr(f"75L + (25L * n * {total.docs}L) div {max(1, total.terms)}L")
    sized = table.select(m.alias("m"), F.size("terms").alias("k")).groupBy("m").agg(F.greatest(F.ceil(F.count(F.lit(1)) / part_docs), F.ceil(F.sum("k") / part_postings)).cast("int").alias("cuts"))
    strata = staged(sized, "strata")
    cut = table.withColumn("m", m).join(broadcast_if_small(strata), "m").withColumn("s", F.pmod(F.xxhash64("rid"), F.col("cuts")).cast("int"))
    parts = staged(cut.select("m", "s", "id", "terms", "tfs").groupBy("m", "s").applyInArrow(_build, _PART), "index")
    discard(table, strata)
    return Index(parts, total.docs, total.terms)


def _impact(tf: np.ndarray, m: int) -> np.ndarray:
    """A term's impact for each tf in the stratum of m."""
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _list(b: pa.RecordBatch, i: int, name: str) -> pa.Array:
    return b.column(name)[i].values


def _numbers(b: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    return _list(b, i, name).to_numpy(zero_copy_only=False)


def _asked(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of items the terms that the part holds: place of the item, place of the term in the part, weight."""
    at = pc.index_in(_list(b, i, "i_terms"), value_set=_list(b, i, "terms"))
    held = np.asarray(at.is_valid().to_numpy(zero_copy_only=False), bool)
    owner = np.repeat(np.arange(len(_list(b, i, "qs"))), _numbers(b, i, "i_sizes"))
    return owner[held], at.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), _numbers(b, i, "i_weights")[held]


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            m, qs = b.column("m")[i].as_py(), _numbers(b, i, "qs")
            owner, term, weight = _asked(b, i)
            bound = np.zeros(len(qs), np.int64)
            np.add.at(bound, owner, weight * _impact(_numbers(b, i, "most")[term], m))
            some = np.flatnonzero(bound)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), m)), pa.array(np.full(len(some), b.column("s")[i].as_py(), np.int32)), pa.array(np.full(len(some), b.column("g")[i].as_py(), np.int32)), pa.array(qs[some]), pa.array(bound[some])], ["m", "s", "g", "q", "bound"])


def _scores(k: int):
    """Each visiting item's k best documents of a part, no worse than the item's limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                docs, members = _list(b, i, "docs"), _numbers(b, i, "members")
                impact = np.repeat(_impact(_numbers(b, i, "run_tf"), b.column("m")[i].as_py()), _numbers(b, i, "run_len"))
                ends = np.cumsum(_numbers(b, i, "dfs"))
                owner, term, weight = _asked(b, i)
                place = {q: p for p, q in enumerate(_numbers(b, i, "qs").tolist())}
                unknown = np.asarray(docs.is_null().to_numpy(zero_copy_only=False), bool)
                ids = docs.fill_null(0).to_numpy(zero_copy_only=False)
                for v in b.column("visits")[i].as_py():
                    own = slice(*np.searchsorted(owner, [place[v["q"]], place[v["q"]] + 1]))
                    score = np.zeros(len(docs), np.int64)
                    for t, w in zip(term[own].tolist(), weight[own].tolist(), strict=True):
                        span = slice(ends[t - 1] if t else 0, ends[t])
                        score[members[span]] += w * impact[span]
                    good = np.flatnonzero(score >= v["least"])
                    best = good[np.lexsort((ids[good], unknown[good], -score[good]))[:k]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), v["q"])), docs.take(pa.array(best)), pa.array(score[best])], ["q", "doc_id", "score"])

    return run


def _blocks(index: Index, asked: DataFrame, size: int) -> DataFrame:
    """Items (rid, terms, tfs) with the weights of their terms, in blocks of ``size`` items."""
    each = asked.select("rid", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("rid", F.col("t.terms").alias("term"), F.col("t.tfs").cast("long").alias("tf"))
    wanted = staged(each.select("term").distinct(), "wanted-terms")
    held = index.parts.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
    dfs = held.join(broadcast_if_small(wanted), "term").groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2 * index.n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    per_item = each.join(dfs, "term").where(w > 0).groupBy("rid").agg(F.collect_list(F.struct("term", (w * F.col("tf")).alias("weight"))).alias("ts"))
    g = F.pmod(F.xxhash64("rid"), F.lit(max(1, -(-asked.count() // size)))).cast("int")
    packed = per_item.groupBy(g.alias("g")).agg(F.collect_list(F.struct("rid", "ts")).alias("x"))
    terms = F.flatten(F.col("x.ts"))
    blocks = staged(packed.select("g", F.col("x.rid").alias("qs"), F.transform("x.ts", F.size).alias("i_sizes"), F.transform(terms, lambda t: t["term"]).alias("i_terms"), F.transform(terms, lambda t: t["weight"]).alias("i_weights")), "item-blocks")
    discard(wanted)
    return blocks


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 20, first: int = 4, block: int = 512) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item with a score above 0.

    Every row of ``items`` is an item of its own, whatever its id; one that is null or
    holds no term gives no rows. A term's weight falls with the number of documents that
    hold it and counts as often as the item repeats it. Equal scores go by ascending
    doc_id, null ids last. ``first`` parts are visited before there is a limit; the
    result does not depend on it, nor on the sizes of parts and blocks.
    """
    asked = forward(items, id_col, text_col)
    blocks = _blocks(index, asked, block)
    groups = [r["g"] for r in blocks.select("g").collect()] or [0]
    each = index.parts.select("m", "s", "terms", "most").withColumn("g", F.explode(F.array(*map(F.lit, groups))))
    bounds = staged(each.join(broadcast_if_small(blocks), "g").mapInArrow(_bounds, "m long, s int, g int, q long, bound long"), "bounds")

    def best(rows: DataFrame, n: int, *order: Column) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= n)

    def visited(which: DataFrame, tag: str) -> DataFrame:
        """The scores of pairs (part, item); a part's items are at most those of a block."""
        grouped = staged(which.groupBy("m", "s", "g").agg(F.collect_list(F.struct("q", "least")).alias("visits")), f"{tag}-visits")
        both = index.parts.join(broadcast_if_small(grouped), ["m", "s"]).join(broadcast_if_small(blocks), "g")
        scores = staged(both.select("m", "docs", "terms", "dfs", "run_tf", "run_len", "members", "visits", "qs", "i_sizes", "i_terms", "i_weights").mapInArrow(_scores(k), "q long, doc_id long, score long"), f"{tag}-scores")
        discard(grouped)
        return scores

    begin = best(bounds, first, F.desc("bound"), F.col("m"), F.col("s"))
    found = visited(begin.withColumn("least", F.lit(1).cast("long")), "first")
    limits = best(found, k, F.desc("score")).where(F.col("rank") == k).select("q", F.col("score").alias("least"))
    rest = bounds.join(begin.select("m", "s", "q"), ["m", "s", "q"], "left_anti").join(limits, "q", "left").withColumn("least", F.coalesce("least", F.lit(1).cast("long"))).where(F.col("bound") >= F.col("least"))
    more = visited(rest, "rest")
    discard(bounds)
    ranked = best(found.unionByName(more), k, F.desc("score"), F.col("doc_id").asc_nulls_last())
    return ranked.join(asked.select(F.col("rid").alias("q"), F.col("id").alias("item_id")), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
