"""Removal of long strings that occur more than once, by sorting sampled suffixes.

Strings of ``length`` bytes are compared without a suffix array of every position,
whose tuples alone would be many times the input. Suffixes are sampled so that equal
strings are sampled alike, names of sampled suffixes come from Spark's disk-backed
sort, and only positions between samples whose names do not decide are induced from
them, in three steps:

1. In each window of ``length`` bytes the k-gram with the least hash is its anchor
   (of equal ones the last), so equal windows have equal anchors at equal places. An
   anchor is named by its k-gram. A span starts with an anchor and reaches far enough
   to hold every window that starts before the next anchor; it is named by its content.
   A span whose name occurs again is removed whole: each of its bytes lies in a string
   of ``length`` bytes that also starts elsewhere.
2. What spans leave are windows at the ends of repeats. A window can repeat only if its
   own anchor does; such windows are named by their content, and so are the windows in
   the first occurrence of each repeated span, which stand for those in the others.
   Names are counted again.
3. Covered bytes are joined to runs and removed.

Names are 64-bit hashes of content and length. Long texts are cut into segments that
overlap by ``length`` - 1 bytes, so that each window lies in one segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages
from .common import broadcast_if_small, discard, staged
from .names import Names, runs

GRAM = 200
SEGMENT = 1 << 19
#: Names that are counted together within a task.
COUNTED = 1 << 20
_NO_ID = -(1 << 63)
_POS = np.uint64((1 << 20) - 1)


class Segment(Names):
    """Anchors, spans and names of one stretch of bytes."""

    def __init__(self, data: np.ndarray, length: int, gram: int, segment: int) -> None:
        super().__init__(data, segment + length)
        self.n, self.length, self.gram = len(data), length, gram
        grams = np.arange(self.n - gram + 1)
        key = (self.names(grams, grams + gram) & ~_POS) | (_POS - grams.astype(np.uint64))
        w, cur = length - gram + 1, 1
        while 2 * cur <= w:
            key = np.minimum(key[:-cur], key[cur:])
            cur *= 2
        if w > cur:
            key = np.minimum(key[: len(key) - (w - cur)], key[w - cur :])
        anchor = (_POS - (key & _POS)).astype(np.int64)  # of each window
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        self.anchors, self.owner = anchor[new], np.cumsum(new) - 1
        self.starts = np.unique(np.concatenate([[0], self.anchors[self.anchors <= self.n - length]]))
        stops = np.concatenate([self.anchors + gram, [self.n]])
        reach = np.append(self.starts[1:], self.n - length + 1) - 1 + length
        self.ends = stops[np.searchsorted(stops, reach)]

    def samples(self) -> np.ndarray:
        """Names of the anchors, then of the spans."""
        return np.concatenate([self.names(self.anchors, self.anchors + self.gram), self.names(self.starts, self.ends)])

    def decide(self, repeated: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Covered bytes, and the windows to be named, given which samples repeat and which are the first of their name.

        Windows that reach a byte not yet covered come first; the others are only there to be found.
        """
        k = len(self.anchors)

        def over(own: np.ndarray, short: int) -> np.ndarray:
            edge = np.zeros(self.n + 1, np.int64)
            np.add.at(edge, self.starts[own], 1)
            np.add.at(edge, self.ends[own] - short, -1)
            return np.cumsum(edge[:-1]) > 0

        p = np.arange(self.n - self.length + 1)
        slot = np.searchsorted(self.starts, p, side="right") - 1
        todo = (~repeated[k:][slot] & repeated[self.owner]) | over(repeated[k:] & first[k:], self.length - 1)[: len(p)]
        covered = over(repeated[k:], 0)
        open_ = np.concatenate([[0], np.cumsum(~covered)])
        reach = open_[p + self.length] > open_[p]
        return covered, p[todo & reach], p[todo & ~reach]


def _segments(raw: bytes, length: int, gram: int, segment: int) -> Iterator[tuple[int, Segment]]:
    data = np.frombuffer(raw, np.uint8)
    for at in range(0, len(data) - length + 1, segment):
        yield at, Segment(data[at : at + segment + length - 1], length, gram, segment)


_RUNS = [f"{k}_{e}" for k in ("covered", "wanted", "seen") for e in ("from", "to")]


def _positions(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places within runs, in order."""
    n = end - start
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64), kind))


def _again(each: DataFrame, *more: F.Column) -> DataFrame:
    """The names that occur more than once, with more aggregates."""
    return staged(each.groupBy("name").agg(F.count(F.lit(1)).alias("c"), *more).where("c > 1").drop("c"), "names")


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rid, raw, th``: id (a fixed number for none), bytes (null: empty) and their hash."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("rid"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("raw")).withColumn("th", F.xxhash64("raw"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = GRAM, segment: int = SEGMENT, passage: int = 51) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, ``kept`` (the bytes that stay where any go) and ``shares_passage``.

    A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
    else in any text, the same one included; matches do not cross texts. A null text is
    empty; texts shorter than ``length`` stay whole. Repeated rows are copies of each
    other like any two rows. ``kept`` is null where nothing goes. ``shares_passage`` is 1
    where the text has a passage of ``passage`` words with another document in common
    (see ``passages``), which can be shorter than ``length`` bytes; nothing goes for that.
    """
    rows = rows_of(docs, id_col, text_col)
    sharing = passages.sharing(rows, passage)
    facts = rows.select("rid", "th", F.octet_length("raw").cast("long").alias("n_bytes"), F.sha2("raw", 256).alias("sha"))
    long_ = rows.where(F.octet_length("raw") >= length)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [np.concatenate([s.samples() for _, s in _segments(raw.as_py(), length, gram, segment)]).view(np.int64) for raw in b.column("raw")]
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("th"), _lists(names, pa.int64())], ["rid", "th", "names"])

    samples = staged(long_.mapInArrow(sample, "rid long, th long, names array<long>"), "samples")
    each = samples.select("rid", "th", F.posexplode("names").alias("i", "name")).withColumn("tag", F.xxhash64("rid", "th", "i"))
    again = _again(each, F.min("tag").alias("first"))
    # of each repeated sample twice its place, plus 1 where it is the first occurrence of its name
    hits = staged(each.join(again, "name").groupBy("rid", "th").agg(F.collect_list(F.col("i") * 2 + (F.col("tag") == F.col("first")).cast("int")).alias("hits")), "repeated-samples")
    discard(samples, again)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for raw, own in zip(b.column("raw"), b.column("hits"), strict=True):
                raw, own = raw.as_py(), np.asarray(own.values)
                covered, wanted, seen = (np.zeros(len(raw), bool) for _ in range(3))
                at = 0
                flags = np.zeros((2, int(own.max()) // 2 + 1), bool)
                flags[0, own // 2] = True
                flags[1, own[own % 2 == 1] // 2] = True
                for base, s in _segments(raw, length, gram, segment):
                    k = len(s.anchors) + len(s.starts)
                    mine = np.zeros((2, k), bool)
                    part = flags[:, at : at + k]
                    mine[:, : part.shape[1]] = part
                    at += k
                    c, p, other = s.decide(*mine)
                    covered[base : base + s.n] |= c
                    wanted[p + base] = True
                    seen[other + base] = True
                for k, mask in enumerate((covered, wanted, seen)):
                    for held, ends in zip(out[2 * k : 2 * k + 2], runs(mask), strict=True):
                        held.append(ends)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("rid", "th", "raw")), *(_lists(x, pa.int64()) for x in out)], ["rid", "th", "raw", *_RUNS])

    def named(kinds: tuple[str, ...], counted: bool = False):
        """The names of the windows of these kinds, in order, made anew from the text rather than kept; or how often a batch has each.

        Most names occur once, so that counts are merged here by batches and not by a
        hash table of the task, which would spill.
        """

        def counts(names: list[np.ndarray]) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate([np.empty(0, np.int64), *names]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["name", "n"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                names = []
                for row in zip(b.column("raw"), *(b.column(f"{k}_{e}") for k in kinds for e in ("from", "to")), strict=True):
                    data, ends = np.frombuffer(row[0].as_py(), np.uint8), [np.asarray(x.values) for x in row[1:]]
                    p = np.concatenate([_positions(*ends[2 * k : 2 * k + 2]) for k in range(len(kinds))])
                    own = np.zeros(len(p), np.uint64)
                    for base in range(0, len(data) - length + 1, segment):
                        here = np.flatnonzero((p >= base) & (p < base + segment))
                        if len(here):
                            own[here] = Names(data[base : base + segment + length - 1], segment + length).names(p[here] - base, p[here] - base + length)
                    names.append(own.view(np.int64))
                    if counted and sum(map(len, names)) >= COUNTED:
                        yield counts(names)
                        names = []
                if counted:
                    yield counts(names)
                else:
                    yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("th"), _lists(names, pa.int64())], ["rid", "th", "names"])

        return decided.select("rid", "th", "raw", *(f"{k}_{e}" for k in kinds for e in ("from", "to"))).mapInArrow(run, "name long, n long" if counted else "rid long, th long, names array<long>")

    # one row per different (id, text); equal rows share their result
    keys = staged(hits.select("rid", "th"), "keys")
    once = long_.join(broadcast_if_small(keys), ["rid", "th"], "left_semi").join(hits, ["rid", "th"]).select("rid", "th", "raw", "hits")
    decided = staged(once.mapInArrow(decide, "rid long, th long, raw binary, " + ", ".join(f"{c} array<long>" for c in _RUNS)), "decided")
    discard(hits, keys)
    again = staged(named(("wanted", "seen"), counted=True).repartition("name").groupBy("name").agg(F.sum("n").alias("c")).where("c > 1").select("name"), "names")
    more = named(("wanted",)).select("rid", "th", F.posexplode("names").alias("i", "name")).join(again, "name").groupBy("rid", "th").agg(F.collect_list("i").alias("hits"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for raw, s, e, ws, we, h in zip(*(b.column(c) for c in ("raw", "covered_from", "covered_to", "wanted_from", "wanted_to", "hits")), strict=True):
                raw = raw.as_py()
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, np.asarray(s.values), 1)
                np.add.at(edge, np.asarray(e.values), -1)
                if h.is_valid:
                    p = _positions(np.asarray(ws.values), np.asarray(we.values))[np.unique(np.asarray(h.values))]
                    np.add.at(edge, p, 1)
                    np.add.at(edge, p + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out[0].append(int(gone.sum()))
                out[1].append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                out[2].append(hashlib.sha256(kept).hexdigest())
                out[3].append(kept)
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("th"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.binary())], ["rid", "th", "n_removed", "n_spans", "kept_sha", "kept"])

    cut = decided.join(more, ["rid", "th"], "left").select("rid", "th", "raw", "covered_from", "covered_to", "wanted_from", "wanted_to", "hits").mapInArrow(remove, "rid long, th long, n_removed long, n_spans long, kept_sha string, kept binary")
    found = facts.join(cut.where("n_removed > 0").dropDuplicates(["rid", "th"]), ["rid", "th"], "left").join(broadcast_if_small(sharing).withColumn("shares", F.lit(1)), ["rid", "th"], "left")
    zero = F.lit(0).cast("long")
    return found.select(
        F.when(F.col("rid") != _NO_ID, F.col("rid")).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha", "sha").alias("kept_sha256"), "kept", F.coalesce("shares", F.lit(0)).alias("shares_passage"),
    )
