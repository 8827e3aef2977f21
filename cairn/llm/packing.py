"""Packing of tokenised documents into sequences of a fixed length.

1. Every document becomes pieces of at most ``limit`` tokens; only longer documents are cut.
2. The histogram of piece lengths (at most ``limit`` rows) goes to the driver. Patterns
   of up to five pieces that fill a sequence exactly are listed: for each length, the
   longest first, the fillings whose lengths occur most often. Their repeat counts are
   fitted to the histogram by non-negative least squares with an active set, which
   leaves no more patterns with a count than there are lengths, and rounded without
   using a length more often than it occurs; patterns with the longest member go
   first, as long pieces have the fewest partners.
3. What is left is packed best fit, longest first, by counts of equal lengths.
4. The plan says, for each length, which ranks of its pieces go to which sequences.
   Its size depends on ``limit`` only. Pieces get their ranks from counts by
   (length, salt), so that one frequent length is spread over many tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import staged

_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids and an end id, cut at ``limit``.

    A null text is empty, so it is one piece with the end id alone; repeated rows give their pieces again.
    """
    encode = bpe.encoding(path)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in encode(batches):
            doc, piece, start, length, crc = [], [], [], [], []
            for i, ids in zip(b.column("id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    doc.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64())], [x.split()[0] for x in _PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _PIECES)


def _pair(left: np.ndarray, rest: int, longest: int) -> list[int] | None:
    """The two lengths that fill ``rest`` and of which most are left."""
    a = np.arange(max(1, rest - longest), rest // 2 + 1)
    if not len(a):
        return None
    held = np.where(2 * a == rest, left[a] // 2, np.minimum(left[a], left[rest - a]))
    best = int(held.argmax())
    return [int(a[best]), rest - int(a[best])] if held[best] > 0 else None


def patterns(histogram: np.ndarray, limit: int, common: int = 8) -> np.ndarray:
    """Patterns of up to five pieces that sum to ``limit``, one a row, ascending; unused places hold 0.

    Each length is filled up by no, one, two or three others, the third one of the
    ``common`` most frequent; what a pattern could hold is set aside before the next one.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    rows = []
    for longest in range(limit, 0, -1):
        rest = limit - longest
        while left[longest]:
            options: list[list[int]] = [[]] if not rest else [[rest]] if rest <= longest else []
            if rest > 1 and (two := _pair(left, rest, longest)):
                options.append(two)
            if rest > 2:
                frequent = np.argsort(-left[1 : min(rest - 1, longest + 1)], kind="stable")[:common] + 1
                options += [[int(c), *two] for c in frequent if left[c] and (two := _pair(left, rest - int(c), longest))]
                options += [[int(c), int(c), *two] for c in frequent if left[c] > 1 and rest > 2 * c + 1 and (two := _pair(left, rest - 2 * int(c), longest))]
            counts = [int((left[u] // n).min()) for u, n in (np.unique([longest, *o], return_counts=True) for o in options)]
            if not any(counts):
                break
            n, own = max(zip(counts, options, strict=True), key=lambda x: x[0])
            np.subtract.at(left, [longest, *own], n)
            rows.append([0] * (4 - len(own)) + sorted([longest, *own]))
    return np.unique(np.array(rows, np.int64).reshape(-1, 5), axis=0)


def fit(found: np.ndarray, histogram: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - histogram|.

    The active set starts with all patterns. Those that least squares gives a negative
    count leave it; those outside it whose count would lessen the error come back.
    """
    n = len(found)
    if not n:
        return np.empty(0)
    a = np.zeros((n, len(histogram)))
    np.add.at(a, (np.repeat(np.arange(n), found.shape[1]), found.ravel()), 1)
    a[:, 0] = 0
    goal, gram = a @ histogram, a @ a.T
    active, x = np.ones(n, bool), np.zeros(n)
    for k in range(rounds):
        own = np.flatnonzero(active)
        x[:] = 0
        x[own] = np.linalg.solve(gram[np.ix_(own, own)] + 1e-9 * np.eye(len(own)), goal[own])
        negative = x < -1e-9
        wanted = ~active & (goal - gram @ x > 1e-6 * max(1.0, float(goal.max())))
        if negative.any():
            active &= ~negative
        elif wanted.any() and k < rounds // 2:
            active |= wanted
        else:
            break
    return np.maximum(x, 0)


def plan(histogram: np.ndarray, limit: int) -> tuple[dict[str, np.ndarray], int]:
    """Where the pieces of each length go, and the number of sequences.

    Row i of the plan: pieces of ``length`` with ranks from ``lo``; the r-th of them goes
    to sequence ``base + r // per`` at offset ``offset + (r % per) * length``.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    rows: list[tuple[int, int, int, int, int]] = []
    used = np.zeros(limit + 1, np.int64)
    sequences = 0

    def place(length: int, n: int, base: int, offset: int, per: int) -> None:
        rows.append((length, int(used[length]), base, offset, per))
        used[length] += n
        left[length] -= n

    found = patterns(left, limit)
    x = fit(found, left)
    counts = np.rint(x).astype(np.int64)
    for p in np.lexsort((-x, -found[:, -1])):
        own, times = np.unique(found[p][found[p] > 0], return_counts=True)
        n = min(int(counts[p]), int((left[own] // times).min()))
        if n <= 0:
            continue
        offset = 0
        for v in np.repeat(own, times).tolist():
            place(v, n, sequences, offset, 1)
            offset += v
        sequences += n
    spaces: dict[int, list[tuple[int, int]]] = {}  # free tokens: (first sequence, how many)
    free: list[int] = []

    def add(space: int, base: int, n: int) -> None:
        if not space or not n:
            return
        if space not in spaces:
            bisect.insort(free, space)
            spaces[space] = []
        spaces[space].append((base, n))

    for length in range(limit, 0, -1):
        while left[length]:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                space = free[at]
                base, n = spaces[space].pop()
                if not spaces[space]:
                    del spaces[space], free[at]
            else:
                space, base, n = limit, sequences, -(-int(left[length]) // (limit // length))
                sequences += n
            per = space // length
            full = min(n, int(left[length]) // per)
            if full:
                place(length, full * per, base, limit - space, per)
                add(space - per * length, base, full)
            rest = int(left[length])
            if full < n and rest and rest < per:
                place(length, rest, base + full, limit - space, rest)
                add(space - rest * length, base + full, 1)
                full += 1
            add(space, base + full, n - full)
    rows.sort()
    names = ("length", "lo", "base", "offset", "per")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T, strict=True)), sequences


def pack(found: DataFrame, limit: int = 2048, rows_per_salt: int = 500) -> DataFrame:
    """Adds ``sequence_id long, offset int`` to the rows of ``pieces``.

    Empty input gives no rows. Equal rows get different places. A very long text is many
    pieces of ``limit`` tokens, each a sequence of its own, and a last one packed like any other.
    """
    spark = found.sparkSession
    found = staged(found, "pieces")
    salts = max(1, min(4096, -(-found.count() // rows_per_salt)))
    keyed = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = staged(keyed.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    histogram = np.zeros(limit + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    shared = spark.sparkContext.broadcast(plan(histogram, limit)[0])
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("rank", F.row_number().over(own) - 1).join(base, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("first"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        key = (p["length"] << 44) + p["lo"]
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            i = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            r = rank - p["lo"][i]
            sequence, offset = p["base"][i] + r // p["per"][i], p["offset"][i] + r % p["per"][i] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(sequence, pa.int64()), pa.array(offset, pa.int32())], [*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "rank").mapInArrow(run, f"{_PIECES}, sequence_id long, offset int")
