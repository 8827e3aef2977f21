"""Exact top-k search with vector-approximation files.

Every vector has a short approximation: for each dimension the number of the cell that
its component falls in, one byte. Approximations are one table, in blocks with the
edges of their cells; the exact vectors are another. A search goes in four steps:

1. The approximations are scanned for lower bounds of the scores. Each block returns k of
   them for each query, and the k-th best of all is a limit that the result must reach.
2. They are scanned again for upper bounds; vectors whose upper bound reaches the limit
   are candidates. Exact vectors have not been read up to here.
3. Of each query's candidates the k with the largest upper bounds are read exactly. The
   k-th best score is a better limit.
4. Of the other candidates those whose upper bound reaches this limit are read, and the
   result is certain.

Queries are packed into blocks as well. Blocks of queries are dealt into groups of
bounded size, and each block of approximations meets each group; if all groups together
are small they are broadcast, else Spark shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged

_CELLS = "dim int, rids binary, ids binary, cells binary, low binary, width binary"
_QUERIES = "dim int, g int, q_rids binary, q_ids binary, q_vecs binary, q_least binary"


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows ``vec_id, v``: v holds floor(scale * x) of each component x, as longs.

    Vectors that are null or hold null, NaN or infinite components are left out,
    as are rows without an id.
    """
    x = F.transform(vec_col, lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad)
        .select("vec_id", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))
    )


def _blocks(block: int, row: Callable[..., dict], groups: int = 1):
    """Pack vectors (rid, vec_id, v, least) of one length and one group into rows of at most ``block``, made by ``row``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple]] = {}

        def out(key: tuple[int, int]) -> pa.RecordBatch:
            made = row(key[0], *(np.concatenate(x) for x in zip(*held.pop(key), strict=True)))
            return pa.RecordBatch.from_pylist([made], pa.schema([(c, pa.binary() if isinstance(x, bytes) else pa.int32()) for c, x in made.items()]))

        for b in batches:
            rids, ids = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rid", "vec_id"))
            least, col = b.column("least").to_numpy(zero_copy_only=False).astype(float), b.column("v")
            lens = np.asarray(col.value_lengths())
            flat, start = np.asarray(col.flatten()), np.concatenate([[0], np.cumsum(lens)])
            for dim, g in sorted(set(zip(lens.tolist(), (rids % groups).tolist(), strict=True))):
                rows = np.flatnonzero((lens == dim) & (rids % groups == g))
                vecs = flat[start[rows][:, None] + np.arange(dim)].astype(np.int64)
                for lo in range(0, len(rows), block):
                    part = slice(lo, lo + block)
                    held.setdefault((dim, g), []).append((rids[rows[part]], ids[rows[part]], vecs[part], least[rows[part]]))
                    if sum(len(x[0]) for x in held[dim, g]) >= block:
                        yield out((dim, g))
        for key in list(held):
            yield out(key)

    return pack


def _cell_row(bits: int):
    """A block's approximations: cell numbers, and each dimension's lowest value and width of a cell."""

    def row(dim: int, rids: np.ndarray, ids: np.ndarray, v: np.ndarray, _: np.ndarray) -> dict:
        low = v.min(0)
        width = np.maximum(1, -(-(v.max(0) - low + 1) // (1 << bits)))
        cells = ((v - low) // width).astype(np.uint8)
        return {"dim": dim, "rids": rids.tobytes(), "ids": ids.tobytes(), "cells": cells.tobytes(), "low": low.tobytes(), "width": width.tobytes()}

    return row


def _query_row(groups: int):
    def row(dim: int, rids: np.ndarray, ids: np.ndarray, v: np.ndarray, least: np.ndarray) -> dict:
        return {"dim": dim, "g": int(rids[0] % groups), "q_rids": rids.tobytes(), "q_ids": ids.tobytes(), "q_vecs": v.tobytes(), "q_least": least.tobytes()}

    return row


def _longs(b: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    return np.frombuffer(b.column(name)[i].as_buffer(), np.int64)


def _bounds(b: pa.RecordBatch, i: int, upper: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Upper or lower bounds of all scores of one pair of blocks (own vectors: minus infinity), and the rids of both sides."""
    dim, rids, qrids = b.column("dim")[i].as_py(), _longs(b, i, "rids"), _longs(b, i, "q_rids")
    q = _longs(b, i, "q_vecs").reshape(len(qrids), dim)
    cells = np.frombuffer(b.column("cells")[i].as_buffer(), np.uint8).reshape(len(rids), dim)
    low, width = _longs(b, i, "low"), _longs(b, i, "width")
    first = (low + cells * width).astype(float)
    last = first + (width - 1)
    plus, minus = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    slack = 1e-9 * (np.abs(q).astype(float) @ np.maximum(np.abs(low), np.abs(low + (width << 8))))[:, None]
    out = plus @ last.T + minus @ first.T + slack if upper else plus @ first.T + minus @ last.T - slack
    out[_longs(b, i, "q_ids")[:, None] == _longs(b, i, "ids")[None, :]] = -np.inf
    return out, rids, qrids


def _lower(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                bounds, _, qrids = _bounds(b, i, upper=False)
                best = np.partition(bounds, -k, axis=1)[:, -k:] if bounds.shape[1] > k else bounds
                q, at = np.nonzero(best > -np.inf)
                yield pa.RecordBatch.from_arrays([pa.array(qrids[q]), pa.array(best[q, at])], ["q", "bound"])

    return run


def _upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            bounds, rids, qrids = _bounds(b, i, upper=True)
            least = np.frombuffer(b.column("q_least")[i].as_buffer(), float)
            q, at = np.nonzero((bounds >= least[:, None]) & (bounds > -np.inf))
            yield pa.RecordBatch.from_arrays([pa.array(qrids[q]), pa.array(rids[at]), pa.array(bounds[q, at])], ["q", "rid", "bound"])


def approximations(vectors: DataFrame, bits: int = 6, block: int = 8192) -> tuple[DataFrame, DataFrame]:
    """The table of exact vectors (rid, vec_id, v), and that of their cells in blocks; both are written."""
    exact = staged(vectors.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "v"), "vectors")
    return exact, staged(exact.withColumn("least", F.lit(0.0)).mapInArrow(_blocks(block, _cell_row(bits)), _CELLS), "cells")


def candidates(cells: DataFrame, queries: DataFrame, k: int, query_block: int = 256, group: int = 16384) -> DataFrame:
    """``q, rid, bound``: for each query (rid) the vectors whose upper bound reaches the k-th largest lower bound. Only cells are read."""
    groups = max(1, -(-queries.count() // group))
    each = cells.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def pairs(limits: DataFrame | None) -> DataFrame:
        held = queries.withColumn("least", F.lit(float("-inf"))) if limits is None else queries.join(limits, F.col("rid") == F.col("q"), "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        dealt = held.select("rid", "vec_id", "v", "least") if groups == 1 else held.select("rid", "vec_id", "v", "least").repartition(groups, F.pmod("rid", F.lit(groups)))
        packed = staged(dealt.mapInArrow(_blocks(query_block, _query_row(groups), groups), _QUERIES), "queries")
        return each.join(broadcast_if_small(packed), ["dim", "g"])

    lower = pairs(None).mapInArrow(_lower(k), "q long, bound double")
    ranked = lower.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound")))).where(F.col("r") <= k)
    limits = ranked.where(F.col("r") == k).select("q", F.col("bound").alias("least"))
    return pairs(limits).mapInArrow(_upper, "q long, rid long, bound double")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, bits: int = 6, block: int = 8192, query_block: int = 256, group: int = 16384) -> DataFrame:
    """The k largest inner products of each query with all other vectors.

    ``vectors`` and ``queries`` hold ``vec_id long, v array<long>``; vectors of
    different lengths have no score. A vector with the query's own id is no
    candidate; ties go to the smaller id. Every row counts, repeated ids and
    repeated rows too, among vectors and among queries; queries of one id are one. Components must stay below 2^28 so that scores fit a long;
    bounds carry a relative slack, exact scores are integers. The number of groups of about ``group`` queries
    grows with the queries. Result: ``query_id, rank (from 1), vec_id, score``; empty
    tables give no rows.
    """
    exact, cells = approximations(vectors, bits, block)
    asked = staged(queries.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "v"), "asked")
    found = staged(candidates(cells, asked, k, query_block, group), "candidates")
    def read(which: DataFrame) -> DataFrame:
        """The exact scores of some candidates."""
        both = which.join(exact, "rid").join(broadcast_if_small(asked).select(*(F.col(c).alias(n) for c, n in (("rid", "q"), ("vec_id", "query_id"), ("v", "qv")))), "q")
        score = F.aggregate(F.zip_with("v", "qv", lambda a, b: a * b), F.lit(0).cast("long"), lambda t, x: t + x)
        return both.select("q", "query_id", "rid", "vec_id", score.alias("score"))

    def best(rows: DataFrame, *order: F.Column, by: str = "q") -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)

    first = staged(read(best(found, F.desc("bound"), F.col("rid"))), "first-scores")
    limits = best(first, F.desc("score")).where(F.col("rank") == k).select("q", F.col("score").alias("least"))
    rest = found.join(limits, "q").where(F.col("bound") >= F.col("least")).join(first.select("q", "rid"), ["q", "rid"], "left_anti")
    return best(first.unionByName(read(rest.select("q", "rid", "bound"))), F.desc("score"), F.col("vec_id"), by="query_id").select("query_id", "rank", "vec_id", "score")
