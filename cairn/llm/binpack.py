"""Packing under several limits at once: tokens, segments and loss-bearing tokens.

1. Documents, or examples made of parts with and without loss, become pieces that fit a
   sequence by themselves; only longer ones are cut. Pieces are written with their ids,
   a class (tokens, and loss in steps of 1/32 of a sequence) and a running number within
   their class and write task, so that they need no later shuffle to be ranked.
2. The number of pieces of each class goes to the driver: some thousand classes,
   whatever the corpus. Sequences are composed one kind at a time: of the classes that
   still fit, the one whose demands have the largest dot product with the room left on
   the three limits comes next. A composition is repeated as often as its classes last.
3. Where nothing fits any more and pieces may be cut, the most numerous class gives up
   pieces that fill the rest exactly, and what is cut off is a class like any other. The
   last tokens fill sequences of powers of two, which need no padding.
4. The plan says which ranks of a class go where; tasks look their own pieces up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from . import bpe
from .common import broadcast_if_small, discard, staged

_STEPS = 32
_PIECES = "doc_id long, start long, doc_tokens long, loss int, class int, task int, nth long, ids binary"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


def _class(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> np.ndarray:
    return tokens << 6 | -(-loss * _STEPS // limits.tokens)


def _cuts(loss: np.ndarray, limits: Limits) -> list[int]:
    """Where an example is cut so that each piece keeps the limits; ``loss`` has one flag a token."""
    ends, before = [], np.concatenate([[0], np.cumsum(loss)])
    while not ends or ends[-1] < len(loss):
        at = ends[-1] if ends else 0
        ends.append(min(at + limits.tokens, int(np.searchsorted(before, before[at] + limits.loss, side="right")) - 1))
    return ends


def pieces(df: DataFrame, id_col: str, path: str, text_col: str | None = None, parts_col: str | None = None, limits: Limits = Limits(), end_id: int = 1, lexicon: str | None = None) -> DataFrame:
    """Every row's tokens in pieces that keep the limits, written with the columns of _PIECES.

    Either ``text_col`` is the text, with one end id, and every id bears loss; or
    ``parts_col`` is an array of structs ``text, loss``, each part with an end id, whose
    ids bear loss if the flag is true. A null text is empty; a null or empty array gives
    one end id without loss. Repeated rows give their pieces again.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encoded(texts: pa.Array) -> Iterator[bytes]:
        """Ids of a whole batch at once, so that each of its words is merged once."""
        return iter(bpe._encoder(path, lexicon).encode([t or "" for t in texts.to_pylist()]))

    def tokens(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Ids and loss flags of each row; no flags where all bear loss."""
        if text_col:
            for ids in encoded(b.column(1)):
                yield np.frombuffer(ids + end, "<u4"), None
            return
        flat = b.column(1).flatten()
        ids = encoded(flat.field("text"))
        flags = iter(flat.field("loss").fill_null(False).to_pylist())
        for n in b.column(1).value_lengths().fill_null(0).to_pylist():
            own = [np.frombuffer(next(ids) + end, "<u4") for _ in range(n)] or [np.frombuffer(end, "<u4")]
            loss = [next(flags) for _ in range(n)] or [False]
            yield np.concatenate(own), np.repeat(loss, list(map(len, own)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, whole = TaskContext.get().partitionId(), {}, min(limits.tokens, limits.loss)
        for b in batches:
            rows = []
            for doc, (ids, flags) in zip(b.column(0).to_pylist(), tokens(b), strict=True):
                ends = [*range(whole, len(ids), whole), len(ids)] if flags is None else _cuts(flags, limits)
                for lo, hi in zip([0, *ends], ends, strict=False):
                    loss = hi - lo if flags is None else int(flags[lo:hi].sum())
                    kind = int(_class(hi - lo, loss, limits))
                    nth = seen[kind] = seen.get(kind, -1) + 1
                    part = ids[lo:hi]
                    rows.append((doc, lo, len(ids), loss, kind, task, nth, (part.astype("<u2") if part.max() < 1 << 16 else part).tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in _PIECES.split(", ")])

    return staged(df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col or parts_col).alias("x")).mapInArrow(run, _PIECES), "packing-pieces")


class _Plan:
    """Compositions of sequences from the classes' counts."""

    def __init__(self, counts: dict[int, int], limits: Limits, cut: bool) -> None:
        # with cuts every length may come to be a class; the longest first, so that equal products go to it
        kinds = {int(_class(n, n, limits)) for n in range(1, limits.tokens + 1)} | set(counts) if cut else set(counts)
        self.kinds = sorted(kinds, reverse=True)
        self.at = {c: i for i, c in enumerate(self.kinds)}
        self.limits, self.cut = limits, cut
        self.tokens = np.array([c >> 6 for c in self.kinds], np.int64)
        self.loss = self.tokens if cut else np.minimum(limits.loss, np.array([-(-(c & 63) * limits.tokens // _STEPS) for c in self.kinds], np.int64))
        self.left = np.array([counts.get(c, 0) for c in self.kinds], np.int64)
        #: For each class its pieces: (class of the whole piece, first rank, how many, start in the whole piece).
        self.lots = [[(c, 0, counts[c], 0)] if counts.get(c) else [] for c in self.kinds]
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0

    def _take(self, i: int, n: int, length: int, offset: int) -> None:
        """Put n pieces of class i, or their first ``length`` tokens, into the next n sequences."""
        base, self.left[i] = self.sequences, self.left[i] - n
        while n:
            whole, lo, held, start = self.lots[i].pop()
            own = min(n, held)
            if own < held:
                self.lots[i].append((whole, lo + own, held - own, start))
            self.rows.append((whole, start, lo, length, base, offset))
            rest = int(self.tokens[i]) - length
            if rest:
                j = self.at[int(_class(rest, rest, self.limits))]
                self.lots[j].append((whole, lo, own, start + length))
                self.left[j] += own
            base, n = base + own, n - own

    def _compose(self, room: np.ndarray) -> tuple[list[int], int | None, int]:
        """Classes for one sequence, the class that is cut to fill it up, and the tokens it gives."""
        most = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        used, picks = np.zeros(len(self.left), np.int64), []
        while room[1]:
            fits = np.flatnonzero((self.left > used) & (self.tokens <= room[0]) & (self.loss <= room[2]))
            if not len(fits):
                break
            weight = room / most**2
            best = int(fits[np.argmax(self.tokens[fits] * weight[0] + weight[1] + self.loss[fits] * weight[2])])
            picks.append(best)
            used[best] += 1
            room = room - (self.tokens[best], 1, self.loss[best])
        space = int(min(room[0], room[2]))
        if self.cut and space > 0 and room[1]:
            free = np.where(self.tokens > space, self.left - used, 0)
            if free.any():
                return picks, int(free.argmax()), space
        return picks, None, 0

    def run(self) -> tuple[np.ndarray, int]:
        limits = self.limits
        while total := int((self.left * self.tokens).sum()):
            last = self.cut and total < limits.tokens
            room = np.array([1 << total.bit_length() - 1 if last else limits.tokens, limits.segments, limits.loss], np.int64)
            picks, filler, space = self._compose(room)
            own, times = np.unique([*picks, *([filler] if space else [])], return_counts=True)
            n = 1 if last else int((self.left[own] // times).min())
            offset = 0
            for i in picks:
                self._take(i, n, int(self.tokens[i]), offset)
                offset += int(self.tokens[i])
            if space:
                self._take(filler, n, space, offset)
            self.sequences += n
        return np.array(sorted(self.rows), np.int64).reshape(-1, 6), self.sequences


def plan(counts: dict[int, int], limits: Limits = Limits(), cut: bool = True) -> tuple[np.ndarray, int]:
    """Where pieces go, and the number of sequences.

    A row (class, start, lo, length, base, offset): of pieces of the class with ranks from
    lo on, ``length`` tokens from ``start`` go to sequence base + rank - lo at ``offset``.
    With ``cut`` every token must bear loss.
    """
    return _Plan(counts, limits, cut).run()


def pack(table: DataFrame, limits: Limits = Limits(), cut: bool = True) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, loss, sequence_id, offset`` of pieces in sequences.

    ``table`` is that of ``pieces``. With ``cut`` (all ids bear loss) pieces are cut
    wherever that fills a sequence; without it they stay whole, and ``loss`` may be
    bounded apart from the tokens. Empty input gives no rows.
    """
    spark = table.sparkSession
    counts = staged(table.groupBy("task", "class").agg(F.count(F.lit(1)).alias("n")), "class-counts")
    held = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    rows = plan(held, limits, cut)[0]
    starts = np.flatnonzero(np.concatenate([[True], np.any(rows[1:, :2] != rows[:-1, :2], axis=1)])) if len(rows) else np.empty(0, np.int64)
    shared = spark.sparkContext.broadcast((rows, starts))
    before = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = staged(counts.select("task", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "class-bases")
    ranked = table.join(broadcast_if_small(base), ["task", "class"]).withColumn("rank", F.col("first") + F.col("nth"))
    discard(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, starts = shared.value
        spans = rows[starts, 0] << 32 | rows[starts, 1] if len(rows) else np.empty(0, np.int64)  # (class, start), each with its rows in order of rank
        key = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows)))) << 40 | rows[:, 2]
        for b in batches:
            kind, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("class", "rank"))
            ids, loss = b.column("ids"), b.column("loss").to_numpy(zero_copy_only=False).astype(np.int64)
            start, alive, parts = np.zeros(len(kind), np.int64), np.arange(len(kind)), []
            while len(alive):
                span = np.searchsorted(spans, kind[alive] << 32 | start[alive])
                row = rows[np.searchsorted(key, span << 40 | rank[alive], side="right") - 1]
                parts.append(np.column_stack([alive, start[alive], row[:, 3], row[:, 4] + rank[alive] - row[:, 2], row[:, 5]]))
                start[alive] += row[:, 3]
                alive = alive[start[alive] < kind[alive] >> 6]
            at, own, length, sequence, offset = np.concatenate(parts).T if parts else np.empty((5, 0), np.int64)
            crc = []
            for i, lo, n in zip(at.tolist(), own.tolist(), length.tolist(), strict=True):
                raw = ids[i].as_buffer()
                width = raw.size // (int(kind[i]) >> 6)
                part = raw[lo * width : (lo + n) * width]
                crc.append(zlib.crc32(part if width == 4 else np.frombuffer(part, "<u2").astype("<u4")))
            at_rows = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at_rows), pa.array(b.column("start").to_numpy(zero_copy_only=False)[at] + own), pa.array(length), pa.array(crc, pa.int64()), b.column("doc_tokens").take(at_rows), pa.array(length if cut else loss[at]), pa.array(sequence), pa.array(offset)],
                [x.split()[0] for x in _PLACED.split(", ")],
            )

    return ranked.select("doc_id", "start", "doc_tokens", "loss", "class", "rank", "ids").mapInArrow(run, _PLACED)
