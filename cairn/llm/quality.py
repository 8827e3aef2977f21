"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from one pass over a text's bytes and words. Trees are grown on
binned statistics of a bounded sample of labelled documents, on the driver, and kept
as flat arrays: complete binary trees of equal depth, so that a batch of documents is
scored by walking all trees at once with numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "distinct_words", "top_word", "repeated_next", "upper", "digit", "space",
    "sentence_marks", "other_marks", "high_bytes", "entropy", "log_lines", "line_bytes", "short_lines", "distinct_lines", "ended_lines", "marked_words", "upper_words",
)

_KIND = np.zeros((8, 256))
for _row, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", b".,;:'\"?()-", b"!#$%&*+/<=>@[\\]^_`{|}~", bytes(range(128, 256)), bytes(range(32)), b"abcdefghijklmnopqrstuvwxyz")):
    _KIND[_row, list(_chars)] = 1


def statistics(text: str | None) -> list[float]:
    """The values of FEATURES for one text; a null or empty text has zeros and no infinite value."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digit, space, marks, other, high, _, _ = (_KIND @ hist / n).tolist()
    p = hist[hist > 0] / n
    words = raw.split()
    w = max(1, len(words))
    kinds = Counter(words)
    again = sum(map(bytes.__eq__, words, words[1:]))
    top = max(kinds.values(), default=0) / w
    lines = raw.split(b"\n")
    return [
        np.log1p(n), np.log1p(len(words)), n / w, len(kinds) / w, float(top), again / w, upper, digit, space, marks, other, high,
        float(-(p @ np.log2(p))), np.log1p(len(lines)), n / len(lines), sum(len(x) < 40 for x in lines) / len(lines), len(set(lines)) / len(lines),
        sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines),
        sum(not x[-1:].isalnum() and x[-1:] < b"\x80" for x in kinds) / max(1, len(kinds)),
        sum(x[:2].isupper() for x in kinds) / max(1, len(kinds)),
    ]


@dataclass(frozen=True)
class Model:
    """Flat arrays: split feature and threshold of each inner node, and leaf values, one row per tree."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for the rows of x; all trees step down one level at a time."""
        total = np.full(len(x), self.prior)
        trees, inner = self.feature.shape
        if trees:
            at, tree, row = np.zeros((len(x), trees), np.int64), np.arange(trees), np.arange(len(x))[:, None]
            for _ in range(int(np.log2(inner + 1))):
                at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
            total = total + self.leaf[tree, at - inner].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: int = 8) -> Model:
    """Boost trees for 0/1 targets y, with weights, on histograms of the binned columns of x.

    Without rows the model is a constant 0.5; with one class it is a constant near that class.
    """
    inner = (1 << depth) - 1
    weight = np.ones(len(y)) if weight is None else weight.astype(float)
    mean = float(np.clip(np.average(y, weights=weight) if len(y) else 0.5, 0.001, 0.999))
    prior = float(np.log(mean / (1 - mean)))
    if not len(y) or y.min() == y.max():
        return Model(prior, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    total, out = np.full(len(y), prior), ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            slot = (node - first) * bins
            gain, choice = np.full(width, 1e-9), np.full((width, 2), -1)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = slot + code[:, f]
                g, h, c = (np.bincount(key, w, width * bins).reshape(width, bins).cumsum(1) for w in (grad, hess, weight))
                gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                value = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
                value[(c < least) | (ct - c < least)] = -1
                value[:, len(e) :] = -1
                best = value.argmax(1)
                better = value[np.arange(width), best] > gain
                gain[better] = value[np.arange(width), best][better]
                choice[better] = np.stack([np.full(width, f), best], 1)[better]
            for k in np.flatnonzero(choice[:, 0] >= 0):
                feature[first + k], threshold[first + k] = choice[k, 0], edges[choice[k, 0]][choice[k, 1]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leafs = node - inner
        g, h = np.bincount(leafs, grad, inner + 1), np.bincount(leafs, hess, inner + 1)
        leaf = rate * g / (h + ridge)
        total = total + leaf[leafs]
        for held, value in zip(out, (feature, threshold, leaf), strict=True):
            held.append(value)
    return Model(prior, *(np.array(v) for v in out))


def with_statistics(df: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``id, label, x``: the statistics of each text as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [[float(v) for v in statistics(t.as_py())] for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(x, pa.list_(pa.float64()))], ["id", "label", "x"])

    return df.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text")).mapInArrow(run, "id long, label int, x array<double>")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that are kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 40_000) -> Model:
    """Fit on at most about ``max_rows`` labelled documents outside the held-out part.

    The sample is by a hash of the id, so it is the same in every run; the driver gets
    only its statistics. Of repeated labels of one id the largest counts; labels or ids
    that are null do not. A document row that is repeated counts once for each copy, a null
    text as an empty one; without labelled rows every score is 0.5.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("label"))
    n = known.count()
    slots = 1 << 20
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64(id_col), F.lit(slots)) < slots * max_rows // n)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known.withColumnRenamed(id_col, "id")), "id")
    rows = sorted(with_statistics(sample, "id", "text", "label").toPandas().itertuples(index=False), key=lambda r: (r.id, tuple(r.x)))
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.label for r in rows], float))


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """The columns ``keep`` (all by default) of docs and ``score``, one row per row.

    A null text is scored as an empty one, whole texts are read whatever their length, and
    equal texts have equal scores. A column of docs that is itself called like the score is replaced.
    """
    names = [c for c in (keep or docs.columns) if c != score_col]
    fields = [docs.schema[c] for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b.column(b.num_columns - 1)], float).reshape(-1, len(FEATURES))
            own = b.columns[:-1]
            yield pa.RecordBatch.from_arrays([*own, pa.array(model.scores(x), pa.float64())], [*names, score_col])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return docs.select(*(F.col(f"`{c}`") for c in names), F.col(text_col).alias("__text")).mapInArrow(run, f"{kinds}`{score_col}` double")
