"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

1. Vectors are ordered along a Hilbert curve through their main directions, which come
   from a bounded sample and affect only the order. Consecutive vectors are packed into
   blocks, one row of a written table each, with the least and greatest value of every
   dimension and the labels that occur: the zone map.
2. A request is an anchor with a window of scores, and whether it wants rows of its own
   label or of others. Interval arithmetic over a zone map bounds all scores of a block
   from both sides; a block whose interval misses the window is not read.
3. Each request first reads the few blocks that promise most. Its k-th best score there
   raises the window's lower end, and of the other blocks those are read that still
   reach it. The result is exact.

An anchor's positives are the best of the window without ends, and each of them is a
window for its negatives. Zone maps are read without the vectors. Requests are packed
into groups of bounded size; every zone map meets each group, by broadcast if all groups
are small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import broadcast_if_small, discard, staged

#: Beyond any score: the ends of a window that has none.
_FAR = 1 << 62
_BLOCK = "dim int, block long, ids binary, labels binary, vecs binary, low binary, high binary, kinds array<long>"


def labelled(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label", scale: int = 256) -> DataFrame:
    """Rows ``vec_id, label, v``: v holds floor(scale * x) of each component x.

    Rows whose id, label or vector is null, or whose vector holds a null, NaN or
    infinite component, are left out; other columns are dropped.
    """
    x = F.transform(vec_col, lambda e: e.cast("double"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad).select("vec_id", "label", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of cell numbers below 2^bits; columns * bits must be below 64."""
    x = cells.astype(np.int64).T.copy()
    for q in (1 << b for b in range(bits - 1, 0, -1)):  # undo the turns and mirrorings of each level
        for own in x:
            inside = (own & q) != 0
            swap = np.where(inside, 0, (x[0] ^ own) & (q - 1))
            x[0] ^= np.where(inside, q - 1, swap)
            own ^= swap
    for i in range(1, len(x)):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[-1] & q, q - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for own in x:
            key = key << 1 | own >> b & 1
    return key


def _axes(vectors: DataFrame, dims: int, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of vectors among ``sample`` rows: the main directions, and the least and greatest place along them."""
    rows = vectors.select("v").orderBy(F.xxhash64("rid")).limit(sample).collect()
    out = {}
    for dim in {len(r["v"]) for r in rows} - {0}:
        x = np.array([r["v"] for r in rows if len(r["v"]) == dim], float)
        axes = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:dims]
        at = x @ axes.T
        out[dim] = axes, at.min(0), at.max(0)
    return out


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, starts and all components of a batch's vectors."""
    lens = b.column("v").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lens, np.cumsum(lens) - lens, b.column("v").flatten().to_numpy(zero_copy_only=False)


def _keyed(axes: dict, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens, start, flat = _flat(b)
            key = np.zeros(len(lens), np.int64)
            for dim in set(lens.tolist()) & set(axes):
                rows = np.flatnonzero(lens == dim)
                directions, lo, hi = axes[dim]
                at = flat[start[rows][:, None] + np.arange(dim)] @ directions.T
                cells = np.floor((at - lo) / np.maximum(hi - lo, 1e-9) * (1 << bits))
                key[rows] = hilbert(np.clip(cells, 0, (1 << bits) - 1), bits)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lens, pa.int32()), pa.array(key)], [*b.schema.names, "dim", "key"])

    return run


def _packed(size: int):
    """Consecutive vectors of one length as rows of at most ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 33, 0
        held: list[tuple] = []
        kept = 0

        def out(ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray) -> pa.RecordBatch:
            row = {"dim": vecs.shape[1], "block": first + n, "ids": ids.tobytes(), "labels": labels.tobytes(), "vecs": vecs.tobytes(), "low": vecs.min(0).tobytes(), "high": vecs.max(0).tobytes(), "kinds": np.unique(labels).tolist()}
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64())]
            return pa.RecordBatch.from_pylist([row], pa.schema(list(zip(row, kinds, strict=True))))

        for b in batches:
            lens, start, flat = _flat(b)
            ids, labels = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "label"))
            cuts = np.flatnonzero(np.diff(lens)) + 1
            for rows in np.split(np.arange(len(lens)), cuts):
                while len(rows):
                    dim = int(lens[rows[0]])
                    if held and (kept >= size or held[0][2].shape[1] != dim):
                        yield out(*(np.concatenate(x) for x in zip(*held, strict=True)))
                        held, kept, n = [], 0, n + 1
                    own, rows = rows[: size - kept], rows[size - kept :]
                    held.append((ids[own], labels[own], flat[start[own][:, None] + np.arange(dim)].astype(np.int64)))
                    kept += len(own)
        if held:
            yield out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def blocks(vectors: DataFrame, size: int = 256, dims: int = 8, bits: int = 6, sample: int = 1024) -> DataFrame:
    """All vectors (rid, vec_id, label, v) in blocks along the curve, written; the curve's directions are fitted on ``sample`` rows."""
    keyed = vectors.select("rid", "vec_id", "label", "v").mapInArrow(_keyed(_axes(vectors, dims, sample), bits), "rid long, vec_id long, label long, v array<long>, dim int, key long")
    order = ["dim", "key", "vec_id", "rid"]
    return staged(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed(size), _BLOCK), "blocks")


def _array(b: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    """Longs of a binary or a list."""
    x = b.column(name)[i]
    return np.frombuffer(x.as_buffer(), np.int64) if pa.types.is_binary(x.type) else x.values.to_numpy(zero_copy_only=False)


def _group(b: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
    """A group of requests."""
    out = {c: _array(b, i, c) for c in ("ws", "a_ids", "a_labels", "same", "least", "most")}
    return out | {"vecs": _array(b, i, "a_vecs").reshape(len(out["ws"]), b.column("dim")[i].as_py())}


def _intervals(b: pa.RecordBatch, rows: list[int], asked: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of the scores of requests (rows) in blocks (columns); minus and plus infinity where no row of a block is wanted or the window is missed."""
    low, high = (np.stack([_array(b, i, c) for i in rows]).astype(float) for c in ("low", "high"))
    v = asked["vecs"].astype(float)
    plus, minus = np.maximum(v, 0), np.minimum(v, 0)
    slack = 1e-9 * (np.abs(v) @ np.maximum(np.abs(low), np.abs(high)).T)
    upper, lower = plus @ high.T + minus @ low.T + slack, plus @ low.T + minus @ high.T - slack
    for k, i in enumerate(rows):
        kinds = _array(b, i, "kinds")
        own = np.isin(asked["a_labels"], kinds)
        missed = np.where(asked["same"] == 1, ~own, own & (len(kinds) == 1)) | (upper[:, k] < asked["least"]) | (lower[:, k] > asked["most"])
        upper[missed, k], lower[missed, k] = -np.inf, np.inf
    return upper, lower


def _by_group(b: pa.RecordBatch) -> Iterator[tuple[int, list[int]]]:
    rows: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(zip(b.column("dim").to_pylist(), b.column("g").to_pylist(), strict=True)):
        rows.setdefault(key, []).append(i)
    for (_, g), own in rows.items():
        yield g, own


def _promising(first: int):
    """Of each batch's blocks the ``first`` that promise each request most: those whose interval lies around or nearest to the window's upper end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, rows in _by_group(b):
                asked = _group(b, rows[0])
                upper, lower = _intervals(b, rows, asked)
                ends = asked["most"].astype(float)[:, None]
                worth = np.where(ends >= _FAR, upper, -np.abs((upper + lower) / 2 - ends))
                worth[upper == -np.inf] = -np.inf
                order = np.argsort(-worth, axis=1, kind="stable")[:, :first]
                best = np.take_along_axis(worth, order, 1)
                q, at = np.nonzero(best > -np.inf)
                block = b.column("block").to_numpy(zero_copy_only=False)[np.array(rows)[order[q, at]]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), g, np.int32)), pa.array(asked["ws"][q]), pa.array(block), pa.array(best[q, at])], ["g", "w", "block", "worth"])

    return run


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and group the requests whose window the block may reach, but for those that have read it."""
    for b in batches:
        for g, rows in _by_group(b):
            asked = _group(b, rows[0])
            upper, _ = _intervals(b, rows, asked)
            seen = b.column("seen")[rows[0]].as_py()
            read = {(w, s) for w, own in zip(asked["ws"].tolist(), seen, strict=True) for s in own}
            for k, i in enumerate(rows):
                block = b.column("block")[i].as_py()
                ws = [w for w in asked["ws"][upper[:, k] > -np.inf].tolist() if (w, block) not in read]
                if ws:
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([g], pa.int32()), pa.array([ws], pa.list_(pa.int64()))], ["block", "g", "visits"])


def _products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows; by floating point where every partial sum is exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    return (a.astype(float) @ x.astype(float).T).astype(np.int64) if largest < 2**53 else a @ x.T


def _scores(k: int):
    """The k best rows of a block for each request that reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, labels = _array(b, i, "ids"), _array(b, i, "labels")
                vecs = _array(b, i, "vecs").reshape(len(ids), b.column("dim")[i].as_py())
                asked = _group(b, i)
                which = np.flatnonzero(np.isin(asked["ws"], _array(b, i, "visits")))
                score = _products(asked["vecs"][which], vecs)
                wanted = ((labels[None, :] == asked["a_labels"][which][:, None]) == (asked["same"][which][:, None] == 1)) & (ids[None, :] != asked["a_ids"][which][:, None])
                wanted &= (score >= asked["least"][which][:, None]) & (score <= asked["most"][which][:, None])
                order = np.lexsort((np.broadcast_to(ids, score.shape), -score, ~wanted))[:, :k]
                q, at = np.nonzero(np.take_along_axis(wanted, order, 1))
                at = order[q, at]
                yield pa.RecordBatch.from_arrays([pa.array(asked["ws"][which][q]), pa.array(ids[at]), pa.array(score[q, at])], ["w", "vec_id", "score"])

    return run


def best_in_windows(table: DataFrame, requests: DataFrame, k: int = 5, first: int = 2, group: int = 256) -> DataFrame:
    """``w, vec_id, score, rank``: for each request the k highest scores within its window, ties by the smaller vec_id.

    ``table`` is that of ``blocks``; ``requests`` are a written table of ``w, a_id,
    a_label, v, same, low, high``: a unique number, the anchor's id, label and vector,
    whether rows of its label are wanted (else those of other labels), and the closed
    window. Rows with the anchor's id and vectors of another length are never found;
    every other row counts, also where ids repeat.
    """
    groups = max(1, -(-requests.count() // group))
    dealt = requests.select("*", F.size("v").alias("dim"), F.pmod(F.xxhash64("w"), F.lit(groups)).cast("int").alias("g"))

    def grouped(rows: DataFrame) -> DataFrame:
        """Requests with their lower end and the blocks that they have read, one row a group."""
        one = F.struct("w", "a_id", "a_label", F.col("same").cast("long").alias("same"), "least", "high", "v", "seen")
        x = rows.groupBy("dim", "g").agg(F.collect_list(one).alias("x"))
        names = {"ws": "w", "a_ids": "a_id", "a_labels": "a_label", "same": "same", "least": "least", "most": "high", "seen": "seen"}
        return staged(x.select("dim", "g", *(F.col(f"x.{c}").alias(n) for n, c in names.items()), F.flatten("x.v").alias("a_vecs")), "requests")

    def meeting(packed: DataFrame) -> DataFrame:
        """Each zone map with each group of requests of its length."""
        zones = table.select("dim", "block", "low", "high", "kinds").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        return zones.join(broadcast_if_small(packed), ["dim", "g"])

    def best(rows: DataFrame, n: int, *order: Column) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("w").orderBy(*order))).where(F.col("rank") <= n)

    def read(visits: DataFrame, packed: DataFrame) -> DataFrame:
        """Scores of the visited blocks; visits has block, g and the requests' numbers."""
        written = staged(visits, "visits")
        both = table.select("dim", "block", "ids", "labels", "vecs").join(broadcast_if_small(written), "block").join(broadcast_if_small(packed), ["dim", "g"])
        found = staged(both.mapInArrow(_scores(k), "w long, vec_id long, score long"), "window-scores")
        discard(written)
        return found

    opening = grouped(dealt.withColumns({"least": F.col("low"), "seen": F.array().cast("array<long>")}))
    chosen = staged(best(meeting(opening).mapInArrow(_promising(first), "g int, w long, block long, worth double"), first, F.desc("worth"), F.col("block")), "chosen")
    begun = read(chosen.groupBy("block", "g").agg(F.collect_list("w").alias("visits")), opening)
    limits = best(begun, k, F.desc("score")).where(F.col("rank") == k).select("w", F.col("score").alias("reached"))
    seen = chosen.groupBy("w").agg(F.collect_list("block").alias("seen"))
    again = dealt.join(limits, "w", "left").join(seen, "w", "left").withColumns({"least": F.greatest("low", F.coalesce("reached", "low")), "seen": F.coalesce("seen", F.array().cast("array<long>"))})
    closing = grouped(again)
    rest = read(meeting(closing).mapInArrow(_reached, "block long, g int, visits array<long>"), closing)
    out = staged(best(begun.unionByName(rest), k, F.desc("score"), F.col("vec_id")), "best-in-windows")
    discard(opening, chosen, closing, begun, rest)
    return out


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, block: int = 256) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` are those of ``labelled``, ``anchors`` a condition on their ``vec_id``.
    An anchor's positives are the best rows of its label, and a positive's negatives the
    best rows of other labels that score from ``low`` to ``high`` per cent of it; the
    window of a positive with a negative score is empty. Each anchor row counts by
    itself. Scores must stay below 2^55. Empty tables give no rows.
    """
    rows = staged(vectors.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "v"), "labelled")
    table = blocks(rows, block)
    far = F.lit(_FAR).cast("long")
    asked = staged(rows.where(anchors).select(F.col("rid").alias("w"), F.col("vec_id").alias("a_id"), F.col("label").alias("a_label"), "v", F.lit(True).alias("same"), (-far).alias("low"), far.alias("high")), "anchors")
    held = best_in_windows(table, asked, positives).withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score", "w": "anchor"}).drop("rank")
    p = F.col("positive_score")
    span = {"low": F.expr(f"({low} * positive_score + 99) div 100"), "high": F.expr(f"({high} * positive_score) div 100"), "same": F.lit(False)}
    windows = held.where(p >= 0).join(asked.select(F.col("w").alias("anchor"), "a_id", "a_label", "v"), "anchor").withColumns(span)
    wanted = staged(windows.select(F.monotonically_increasing_id().alias("w"), "a_id", "a_label", "v", "same", "low", "high", "positive_id", "positive_score"), "windows")
    found = best_in_windows(table, wanted.drop("positive_id", "positive_score"), negatives)
    return found.join(wanted.select("w", "a_id", "positive_id", "positive_score"), "w").select(
        F.col("a_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
