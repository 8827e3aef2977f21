"""Documents that share a passage of so many words with another one.

The companion of ``suffix`` for passages that are long in words but short in bytes.

1. In each window of ``words`` words the gram of ``gram`` words with the least hash is
   its anchor, so equal windows have equal anchors. Anchors are named by content and
   names that occur in different documents are kept.
2. The windows of such anchors are named and counted again. Within a stretch of kept
   anchors only the first window of each inner anchor is looked at, as in a long shared
   stretch the inner anchors own the same windows in both documents.
3. For documents that this leaves with kept anchors but without a shared window, all
   windows of these anchors are looked at, in whatever document the anchors stand.

A document is a different (id, text); words end at blanks, tabs and line ends. Names are
64-bit hashes of content and length. Texts are worked on in slices that overlap by
``words`` - 1 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, staged
from .names import Names, runs

_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_POS = np.uint64((1 << 20) - 1)
#: Words of a slice, and the bytes for which the powers of the hash are kept; longer slices make their own.
SLICE, MOST = 1 << 17, 1 << 20


class Windows:
    """Anchors and windows of one slice of a text."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, words: int, gram: int) -> None:
        self.start, self.end, self.words = start - start[0], end - start[0], words
        own = data[start[0] : end[-1]]
        self.names = Names(own, max(MOST, 1 << (len(own) + 1).bit_length()))
        n = len(start)
        grams = self.names.names(self.start[: n - gram + 1], self.end[gram - 1 :])
        key = (grams & ~_POS) | (_POS - np.arange(len(grams)).astype(np.uint64))
        width, size = words - gram + 1, 1
        while 2 * size <= width:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if width > size:
            key = np.minimum(key[: len(key) - (width - size)], key[width - size :])
        anchor = (_POS - (key & _POS)).astype(np.int64)  # of each window
        self.first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        self.owner = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(anchor))))
        self.anchors = grams[anchor[self.first]]

    def wanted(self, kept: np.ndarray, whole: bool) -> np.ndarray:
        """The names of the windows to look at, given which anchors are kept: all of theirs, or of inner ones the first."""
        inner = kept & np.append(False, kept[:-1]) & np.append(kept[1:], False) & ~whole
        look = (kept & ~inner)[self.owner]
        look[self.first[inner]] = True
        w = np.flatnonzero(look)
        return self.names.names(self.start[w], self.end[w + self.words - 1])


def _slices(raw: bytes, words: int, gram: int) -> Iterator[Windows]:
    data = np.frombuffer(raw, np.uint8)
    start, end = runs(~_BLANK[data])
    for at in range(0, len(start) - words + 1, SLICE):
        part = slice(at, at + SLICE + words - 1)
        yield Windows(data, start[part], end[part], words, gram)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64), pa.int64()))


def _shared(each: DataFrame) -> DataFrame:
    """The names that different documents have."""
    return staged(each.groupBy("name").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a <> b").select("name"), "shared-names")


def sharing(rows: DataFrame, words: int = 51, gram: int = 20) -> DataFrame:
    """``rid, th`` of the rows (rid, th, raw) that share a passage of ``words`` words with another document.

    A null or shorter text shares nothing. Equal rows are one document.
    """

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [np.concatenate([np.empty(0, np.uint64), *(s.anchors for s in _slices(raw.as_py() or b"", words, gram))]).view(np.int64) for raw in b.column("raw")]
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("th"), _lists(names)], ["rid", "th", "names"])

    def windows(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                names = []
                for raw, hits in zip(b.column("raw"), b.column("hits"), strict=True):
                    at, hits, own = 0, np.asarray(hits.values), []
                    kept = np.zeros(int(hits.max()) + 1, bool)
                    kept[hits] = True
                    for s in _slices(raw.as_py(), words, gram):
                        mine = np.zeros(len(s.anchors), bool)
                        part = kept[at : at + len(mine)]
                        mine[: len(part)] = part
                        at += len(mine)
                        own.append(s.wanted(mine, whole))
                    names.append(np.unique(np.concatenate(own)).view(np.int64))
                yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("th"), _lists(names)], ["rid", "th", "names"])

        return run

    doc, kind = F.xxhash64("rid", "th").alias("doc"), "rid long, th long, names array<long>"
    first = staged(rows.select("rid", "th", "raw").mapInArrow(anchors, kind), "anchors")
    each = first.select("rid", "th", doc, F.posexplode("names").alias("i", "name"))

    def with_shared_windows(names: DataFrame, whole: bool) -> DataFrame:
        """The documents that have a window of anchors of these names with another one in common."""
        hits = staged(each.join(broadcast_if_small(names), "name").groupBy("rid", "th").agg(F.collect_set("i").alias("hits")), "kept-anchors")
        found = staged(rows.join(broadcast_if_small(hits), ["rid", "th"]).select("rid", "th", "raw", "hits").mapInArrow(windows(whole), kind), "windows")
        own = found.select("rid", "th", doc, F.explode("names").alias("name"))
        again = _shared(own)
        out = staged(own.join(broadcast_if_small(again), "name").select("rid", "th").distinct(), "sharing")
        discard(hits, found, again)
        return out

    kept = _shared(each.select("doc", "name"))
    most = with_shared_windows(kept, whole=False)
    open_ = each.join(broadcast_if_small(kept), "name").join(broadcast_if_small(most), ["rid", "th"], "left_anti")
    names = staged(open_.select("name").distinct(), "open-names")
    rest = with_shared_windows(names, whole=True)
    out = staged(most.unionByName(rest).distinct(), "sharing")
    discard(first, kept, most, names, rest)
    return out
