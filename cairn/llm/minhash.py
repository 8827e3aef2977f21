"""Near-duplicate documents: one-permutation MinHash, banded buckets, star edges, exact links.

1. A document's word shingles are hashed once; the hash's leading bits name a bin
   and the least hash of each bin is kept (one permutation). Empty bins borrow from
   full ones by a fixed random probe sequence (optimal densification). Bands of bins
   are bucket keys. Small sets use a prefix of their hashes that two sets of the wanted
   similarity must share, which is exact where bins would be few. The hashes that the
   fewest small sets hold come first, so that a passage which many unlike documents
   share makes no bucket of them all.
2. Documents of equal sets are one node. In a bucket every node gets one edge to the
   bucket's centre (a star), so a bucket of m nodes has m - 1 candidate edges.
   The components of these edges are families.
3. Links are confirmed on full sets. A family is cut into blocks of bounded size. The
   first block is compared with every block; what this leaves outside the family's
   main component is compared with all blocks. So every pair that could join two
   components is compared, and a family with one main part costs time in proportion
   to its size. A pair of blocks returns a spanning forest of its links, not all pairs.
4. Confirmed links are joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, staged
from .graph import components

#: Sets and hashes of a block, on average.
BLOCK, BLOCK_HASHES = 1024, 1 << 20
CACHE_WORDS = 500_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_NO_ID = -(1 << 63)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, words = self.known, (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        try:
            h = np.array([known[w] for w in words], np.uint64)
        except KeyError:
            if len(known) > CACHE_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.array([known[w] for w in words], np.uint64)
        n = min(self.words, len(h))
        last = len(h) - n + 1
        out = np.full(last, n, np.uint64)
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + last]
        out = np.sort(_mix(out))
        return out[np.concatenate([[True], out[1:] != out[:-1]])]


class Keys:
    """Bucket keys by bands of a set of hashes, and whether the set is small enough for a prefix, for links of at least ``percent`` per cent."""

    def __init__(self, percent: int, bands: int, rows: int, small: int = 64, seed: int = 7) -> None:
        self.percent, self.bands, self.rows, self.small = percent, bands, rows, small
        bins = bands * rows
        self.edges = np.array([-(-(b << 64) // bins) for b in range(bins)], np.uint64)
        self.probe = np.random.default_rng(seed).integers(0, bins, (bins, 256))

    def has_prefix(self, h: np.ndarray) -> bool:
        return 0 < len(h) * self.percent <= self.small * 100

    def __call__(self, h: np.ndarray) -> np.ndarray:
        n = len(h)
        if n <= self.small:
            return np.empty(0, np.int64)
        at = np.searchsorted(h, self.edges)
        full = at < np.append(at[1:], n)
        sig = h[np.minimum(at, n - 1)]
        todo = np.flatnonzero(~full)
        for a in range(self.probe.shape[1]):
            if not len(todo):
                break
            donor = self.probe[todo, a]
            ok = full[donor]
            sig[todo[ok]] = sig[donor[ok]]
            todo = todo[~ok]
        sig[todo] = h[0]
        sig = sig.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1).astype(np.uint64)
        for r in range(self.rows):
            key = key * np.uint64(0x9E3779B97F4A7C15) + sig[:, r]
        return _mix(key).view(np.int64)


def _rid(id_col: str) -> F.Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))


def _node(h: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh3_128_digest(h.tobytes())[:8], "little", signed=True)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.empty(0, np.int64), pa.int64()))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``rid, th, n, node, keys, few`` per document: hash of the text, size of the shingle set, its node, its bucket keys by bands, and the whole set if it is small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, keys, none = Shingles(words), Keys(percent, bands, rows), np.empty(0, np.int64)
        for b in batches:
            n, node, own, few = [], [], [], []
            for t in b.column("text"):
                h = shingles(t.as_py())
                n.append(len(h))
                node.append(_node(h) if len(h) else None)
                own.append(keys(h))
                few.append(h.view(np.int64) if keys.has_prefix(h) else none)
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("th"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), _lists(own), _lists(few)], ["rid", "th", "n", "node", "keys", "few"])

    cut = docs.select(_rid(id_col).alias("rid"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    return cut.mapInArrow(run, "rid long, th long, n long, node long, keys array<long>, few array<long>")


def _rare_keys(nodes: DataFrame, percent: int) -> DataFrame:
    """``key, node``: of each small set the prefix that a similar set must share, its hashes in order of how many small sets hold them.

    Hashes of one set only come first and make no keys.
    """
    each = nodes.select("node", F.size("few").alias("n"), F.explode("few").alias("h"))
    shared = staged(each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    own = each.join(shared, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h")))["h"].alias("x"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    left = F.greatest(prefix - (F.col("n") - F.size("x")), F.lit(0))
    keys = staged(own.select(F.explode(F.slice("x", F.lit(1), left)).alias("h"), "node").select(F.xxhash64("h", F.lit(1)).alias("key"), "node"), "rare-keys")
    discard(shared)
    return keys


def _star_edges(nodes: DataFrame, rare: DataFrame) -> DataFrame:
    """``a, b``: every node of a bucket with the bucket's centre, its least node."""
    held = nodes.select(F.explode("keys").alias("key"), "node").unionByName(rare)
    centres = held.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("most")).where("centre <> most").select("key", "centre")
    return held.join(centres, "key").where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()


def _sets(docs: DataFrame, id_col: str, text_col: str, members: DataFrame, words: int) -> DataFrame:
    """``node, hashes``: the full set of each node in ``members`` (rid, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for b in batches:
            sets = [shingles(t.as_py()) for t in b.column("text")]
            keep = [i for i, (h, n) in enumerate(zip(sets, b.column("node").to_pylist(), strict=True)) if len(h) and _node(h) == n]
            yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(keep, pa.int64())), pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["node", "hashes"])

    cut = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("rid"), F.col(text_col).alias("text"))
    return cut.join(members, "rid").select("node", "text").mapInArrow(run, "node long, hashes binary").dropDuplicates(["node"])


def _links_of(left: list, right: list | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two lists of (node, set), or within one."""
    others = right if right is not None else left
    if not left or not others or (right is None and len(left) < 2):
        return []
    sizes_l, sizes_r = (np.array([len(h) for _, h in x]) for x in (left, others))

    def flat(x: list, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([h for _, h in x]), np.repeat(np.arange(len(x)), sizes)

    (hl, il), (hr, ir) = flat(left, sizes_l), flat(others, sizes_r)
    common = np.intersect1d(hl, hr) if right is not None else np.unique(hl)
    if right is None:
        kept, n = np.unique(hl, return_counts=True)
        common = kept[n > 1]
    both = np.zeros((len(left), len(others)), np.float32)
    for at in range(0, len(common), 4096):
        part = common[at : at + 4096]

        def matrix(h: np.ndarray, i: np.ndarray, n: int) -> np.ndarray:
            k = np.minimum(np.searchsorted(part, h), len(part) - 1)  # noqa: B023
            hit = part[k] == h  # noqa: B023
            m = np.zeros((n, len(part)), np.float32)  # noqa: B023
            m[i[hit], k[hit]] = 1
            return m

        ml = matrix(hl, il, len(left))
        both += ml @ (ml if right is None else matrix(hr, ir, len(others))).T
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (sizes_l[:, None] + sizes_r[None, :] - both)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = left[i][0], others[j][0]
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b))
    return out


def _confirmed(tasks: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links found in each task (family, i, j), between its sides 0 and 1 or within side 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])
        a: list[int] = []
        b: list[int] = []

        def done() -> None:
            for x, y in _links_of(sides[0], sides[1] if key[1] != key[2] or key[3] else None, percent):
                a.append(x)
                b.append(y)
            sides[0].clear()
            sides[1].clear()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a.clear()
            b.clear()
            return batch

        for batch in batches:
            for f, i, j, two, side, node, raw in zip(*(batch.column(c).to_pylist() for c in ("family", "i", "j", "two", "side", "node", "hashes")), strict=True):
                if key != (f, i, j, two):
                    if key is not None:
                        done()
                    key = (f, i, j, two)
                sides[side].append((node, np.frombuffer(raw, np.uint64)))
            if a:
                yield out()
        if key is not None:
            done()
        yield out()

    dealt = tasks.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    return dealt.select("family", "i", "j", "two", "side", "node", "hashes").mapInArrow(run, "a long, b long")


def _block_of(n: str) -> F.Column:
    return F.pmod(F.xxhash64("node", F.lit(11)), F.col(n)).cast("int")


def _blocks() -> F.Column:
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.octet_length("hashes")) / (8 * BLOCK_HASHES))).cast("int")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links among ``sets`` (family, node, hashes) that give the families' exact components, as a staged table."""
    size = sets.groupBy("family").agg(_blocks().alias("nb"))
    sets = staged(sets.join(size, "family").withColumn("k", _block_of("nb")), "sets")
    j = F.when(F.col("k") == 0, F.sequence(F.lit(0), F.col("nb") - 1)).otherwise(F.array("k"))
    first = sets.select("*", F.explode(j).alias("j")).select("family", F.lit(0).alias("i"), "j", F.lit(False).alias("two"), F.when((F.col("k") == 0), 0).otherwise(1).alias("side"), "node", "hashes")
    found = staged(_confirmed(first, percent), "links")
    if sets.where("nb > 1").isEmpty():
        discard(sets)
        return found
    comp = components(found)
    large = sets.where("nb > 1").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = large.groupBy("family", "component").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("family").agg(F.max(F.struct("c", "component"))["component"].alias("main"))
    large = large.join(main, "family")
    outside = large.where("component <> main").groupBy("family").agg(_blocks().alias("nu"))
    rest = staged(large.join(outside, "family"), "rest")
    left = rest.where("component <> main").select("family", _block_of("nu").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("j"), F.lit(True).alias("two"), F.lit(0).alias("side"), "node", "hashes")
    right = rest.select("family", F.explode(F.sequence(F.lit(0), F.col("nu") - 1)).alias("i"), F.col("k").alias("j"), F.lit(True).alias("two"), F.lit(1).alias("side"), "node", "hashes")
    known = comp.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    more = staged(known.unionByName(_confirmed(left.unionByName(right), percent)), "links")
    discard(sets, rest, found)
    return more


def _linked(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signatures, the nodes with their least id, and ``node, component`` of linked nodes."""
    sig = staged(signatures(docs, id_col, text_col, words, percent, bands, rows), "signatures")
    nodes = staged(sig.where("n > 0").groupBy("node").agg(F.min(F.when(F.col("rid") != _NO_ID, F.col("rid"))).alias("least"), F.max("rid").alias("rid"), F.first("keys").alias("keys"), F.first("few").alias("few")), "nodes")
    rare = _rare_keys(nodes, percent)
    edges = staged(_star_edges(nodes, rare), "stars")
    family = staged(components(edges).withColumnRenamed("component", "family"), "families")
    members = staged(nodes.select("rid", "node").join(family, "node").select("rid", "node"), "members")
    sets = _sets(docs, id_col, text_col, broadcast_if_small(members), words).join(family, "node")
    found = links(sets.select("family", "node", "hashes"), percent)
    comp = components(found)
    discard(rare, edges, family, members, found)
    return sig, nodes, comp


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, bands: int = 24, rows: int = 4) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased,
    words end at blanks, tabs and line ends); a shorter text is one shingle, a text
    without words has an empty set and is linked with nothing. Documents are linked if
    100 * intersection >= percent * union. ``component_id`` is the smallest id that
    links reach, ``kept`` marks the row that has it. Rows without an id take part;
    their component has no id if none of its rows has one. Repeated rows have equal sets.
    """
    sig, nodes, comp = _linked(docs, id_col, text_col, words, percent, bands, rows)
    own = nodes.select("node", "least").join(comp, "node")
    reach = own.groupBy("component").agg(F.min("least").alias("reach"))
    moved = own.join(reach, "component").select("node", "reach").unionByName(nodes.join(comp, "node", "left_anti").select("node", F.col("least").alias("reach")))
    out = sig.select("rid", "n", "node").join(moved, "node", "left")
    doc_id = F.when(F.col("rid") != _NO_ID, F.col("rid"))
    component = F.when(F.col("n") == 0, doc_id).otherwise(F.col("reach"))
    return out.select(doc_id.alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), doc_id.eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, bands: int = 24, rows: int = 4) -> DataFrame:
    """The rows of docs of which one of each component (see ``near_duplicates``) stays.

    Decisions are by id and text: of a component the row with the smallest id stays,
    then with the smallest hash of the text; rows without an id come last and are
    decided likewise. Texts without words are linked with nothing. Of equal rows (same
    id or none, same text) one stays in each case, the least in its other columns.
    """
    sig, _, comp = _linked(docs, id_col, text_col, words, percent, bands, rows)
    sig = sig.groupBy("rid", "th", "n", "node").agg(F.count(F.lit(1)).alias("m"))
    group = sig.where("n > 0").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    stays = group.groupBy("component").agg(F.min(F.struct((F.col("rid") == _NO_ID).alias("none"), "rid", "th")).alias("first"))
    gone = group.join(stays, "component").where((F.col("rid") != F.col("first.rid")) | (F.col("th") != F.col("first.th")))
    gone = staged(gone.select("rid", "th"), "gone").withColumnsRenamed({"rid": "__rid", "th": "__th"})
    kept = docs.withColumns({"__rid": _rid(id_col), "__th": F.xxhash64(text_col)}).join(gone, ["__rid", "__th"], "left_anti")
    twice = staged(sig.where("m > 1").select(F.col("rid").alias("__rid"), F.col("th").alias("__th")), "twice")
    if twice.isEmpty():
        return kept.select(*docs.columns)
    one = kept.join(twice, ["__rid", "__th"]).groupBy("__rid", "__th").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return kept.join(twice, ["__rid", "__th"], "left_anti").select(*docs.columns).unionByName(one)
