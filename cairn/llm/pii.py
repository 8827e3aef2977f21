"""Personal data in texts: candidate spans, boosted trees, calibrated thresholds.

Generators of high recall propose spans, which may overlap. Those of the base kinds
that pass their check are always personal data. Every candidate has features of its
format and of what stands around it, each with a few values only. There are no labels, so
the trees learn from weak ones: a checksum or range where the kind has one, else a word
before the span that announces such data, and for assignments to a secret word whether
the value looks random. The last of these nearly follows from the feature ``mixed``, and
where all candidates of a generator have one label the trees learn no more than the
generator. Counts of the combinations of feature
values are what the trees are fitted on, over one half of the texts; over the other half
a threshold for each generator is the smallest score from which on the candidates are
right often enough. Candidates above it are spans as well.

Everything that touches texts is built from Spark SQL functions. The candidates are
written once, and fitting and selecting read them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality
from .common import let, staged

# Patterns are written so that their matches are those of the plain forms in the
# comments; possessive loops and the guards before a run keep time in proportion to the text.
#: kind -> pattern. Base kinds come first, in the order of the output.
GENERATORS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "hidden_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++",
    "local_phone": r"(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}(?![0-9-])",
    "number": r"(?<![0-9A-Za-z])[0-9]{9,}+(?![0-9A-Za-z])",
    "key": r"(?<![A-Za-z0-9])(?=[A-Za-z0-9]{16})(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{16,}+",
    "secret": r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|auth|(?:api|access|private)[ _-]?key)[\"']? ?[:=]{1,2} ?[\"']?[!#-&(-~]{6,}+[\"']?",
}
BASE = ("email", "ip", "card", "phone")
CUES = r"(?i)(mail|phone|tel|call|fax|mobile|card|visa|account|iban|password|secret|token|key|login|contact|ssn|address)[^A-Za-z]*$"
FEATURES = ("generator", "length", "digits", "upper", "mixed", "letters", "before", "after")
#: Matches of a text are placed in blocks of so many, which keeps the work in proportion to their number.
BLOCK = 64


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _check(kind: str, s: Column, before: Column) -> Column:
    """For base kinds the format check, which decides; for others the weak label that the trees learn from."""
    d = _digits(s)
    n = F.length(d)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return s.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(n.between(16, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    if kind == "number":
        return F.when(n.between(12, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "secret":
        return s.rlike(r"[:=].*(?=[A-Za-z0-9+/_-]{10})(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])")
    return before.rlike(CUES)


def _class(c: Column) -> Column:
    return F.when(c.rlike("[A-Za-z0-9]"), 2).when(c.rlike(r"[\s.,;:()]") | (F.length(c) == 0), 0).otherwise(1)


def _bucket(x: Column, *limits: int) -> Column:
    return reduce(lambda a, b: a + b, [(x > v).cast("int") for v in limits])


def _starts(gaps: Column, lengths: Column) -> Column:
    """Where each match starts, given the lengths of the gaps before the matches and of the matches."""

    def running(first: Column, steps: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            at = acc["at"] + x["gap"]
            return F.struct((at + x["own"]).alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

        return F.aggregate(steps, F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def in_blocks(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(x), F.lit(BLOCK)), lambda i: F.slice(x, i, BLOCK))
        whole = F.transform(blocks, lambda b: F.struct(F.lit(0).alias("gap"), F.aggregate(b, F.lit(0), lambda t, y: t + y["gap"] + y["own"]).alias("own")))
        return let(F.struct(blocks.alias("blocks"), running(F.lit(0), whole).alias("first")), lambda v: F.flatten(F.transform(v["blocks"], lambda b, k: running(F.get(v["first"], k), b))))

    return let(F.zip_with(gaps, lengths, lambda g, n: F.struct(g.alias("gap"), n.alias("own"))), in_blocks)


def candidates(text: Column, kind: str) -> Column:
    """The spans that one generator proposes: array of (kind, start, end, ok, x), in order of start.

    start and end count code points; x holds the values of FEATURES.
    """
    pattern = GENERATORS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), lambda g: F.length(g))
        starts = _starts(gaps, F.transform(m, lambda s: F.length(s)))
        return F.zip_with(starts, m, lambda at, s: F.struct(at.alias("start"), (at + F.length(s)).alias("end"), s.alias("s")))

    def described(c: Column) -> Column:
        s = c["s"]
        before = F.substring(text, F.greatest(c["start"] - 23, F.lit(1)), F.least(c["start"], F.lit(24)))
        after = F.substring(text, c["end"] + 1, F.lit(1))
        n = F.length(s)
        x = F.array(
            F.lit(list(GENERATORS).index(kind)),
            _bucket(n, 12, 16, 24),
            _bucket(F.length(_digits(s)) * 4, *(n, n * 3)),
            s.rlike("[A-Z]").cast("int"),
            (s.rlike("[A-Za-z]") & s.rlike("[0-9]")).cast("int"),
            _bucket(F.length(F.regexp_replace(s, "[^A-Fa-f]", "")) * 4, *(n, n * 2)),
            _class(F.substring(before, -1, 1)),
            _class(after),
        )
        return F.struct(F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), _check(kind, s, before).alias("ok"), x.alias("x"))

    none = F.from_json(F.lit("[]"), "array<struct<kind:string,start:int,end:int,ok:boolean,x:array<int>>>")
    return F.when(text.rlike(pattern), F.transform(let(found, placed), described)).otherwise(none)


def with_candidates(docs: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """A written table of the wanted columns of docs, with ``pii_all``, every generator's candidates, and ``pii_half``, which half the text is in.

    A null text is empty and has no candidates; columns of these names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [c for c in (docs.columns if keep is None else keep) if c not in ("pii_all", "pii_half")]
    return staged(docs.select(*own, F.pmod(F.xxhash64(text), F.lit(2)).cast("int").alias("pii_half"), F.concat(*(candidates(text, k) for k in GENERATORS)).alias("pii_all")), "pii-candidates")


@dataclass(frozen=True)
class Selector:
    """Boosted trees over FEATURES and each generator's threshold."""

    model: quality.Model
    thresholds: dict[str, float]

    def score(self, x: Column) -> Column:
        """The trees as nested conditions: a log-odds score."""
        m = self.model

        def node(t: int, i: int) -> Column:
            inner = m.feature.shape[1]
            if i >= inner:
                return F.lit(float(m.leaf[t, i - inner]))
            if not np.isfinite(m.threshold[t, i]):
                return node(t, 2 * i + 1)
            return F.when(F.get(x, F.lit(int(m.feature[t, i]))) > F.lit(float(m.threshold[t, i])), node(t, 2 * i + 2)).otherwise(node(t, 2 * i + 1))

        return reduce(lambda a, b: a + b, [node(t, 0) for t in range(len(m.feature))], F.lit(m.prior))


def fit(found: DataFrame, trees: int = 12, depth: int = 3, precision: float = 0.9) -> Selector:
    """Fit trees on the candidates of one half of the texts and thresholds on those of the other.

    The driver gets counts of combinations of feature values only: at most 10 generators x
    4 x 3 x 2 x 2 x 3 x 3 x 3 combinations in each half, whatever the corpus. A generator
    without candidates in the second half, and texts without any, add nothing to the base spans.
    """
    each = found.select("pii_half", F.explode("pii_all").alias("c"))
    rows = each.groupBy("pii_half", F.col("c.x").alias("x")).agg(F.count_if(F.col("c.ok")).alias("good"), F.count_if(~F.col("c.ok")).alias("bad")).collect()
    rows.sort(key=lambda r: (r["pii_half"], tuple(r["x"])))
    half = np.array([r["pii_half"] for r in rows], int)
    x = np.array([list(r["x"]) for r in rows], float).reshape(-1, len(FEATURES))
    good, bad = (np.array([r[c] for r in rows], float) for c in ("good", "bad"))
    first = half == 0
    model = quality.fit(np.concatenate([x[first], x[first]]), np.repeat([1.0, 0.0], first.sum()), np.concatenate([good[first], bad[first]]), trees=trees, depth=depth, rate=0.3)
    score = model.scores(x)
    thresholds = {}
    for g, kind in enumerate(GENERATORS):
        own = np.flatnonzero((x[:, 0] == g) & ~first)
        own = own[np.argsort(-score[own], kind="stable")]
        right, all_ = good[own].cumsum(), (good + bad)[own].cumsum()
        ok = np.flatnonzero((right >= precision * np.maximum(all_, 1)) & np.append(score[own][1:] < score[own][:-1], True)[: len(own)])
        least = float(score[own][ok[-1]]) if len(ok) else np.inf
        thresholds[kind] = float(np.log(least / (1 - least)) - 1e-9) if least < 1 else np.inf
    return Selector(model, thresholds)


def with_spans(found: DataFrame, selector: Selector) -> DataFrame:
    """Adds ``pii_base`` and ``pii_spans`` to a table with candidates: arrays of (kind, start, end), by kind as in GENERATORS, then start.

    ``pii_base`` holds the base kinds' matches that pass their checks; ``pii_spans`` holds
    these and the candidates that the trees select. Columns of these names are replaced.
    """
    short = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    is_base = lambda c: c["kind"].isin(*BASE) & c["ok"]
    wanted = [(k, v) for k, v in selector.thresholds.items() if np.isfinite(v)]

    def chosen(c: Column) -> Column:
        if not wanted:
            return is_base(c)
        limit = reduce(lambda w, kv: w.when(c["kind"] == kv[0], F.lit(kv[1])), wanted[1:], F.when(c["kind"] == wanted[0][0], F.lit(wanted[0][1])))
        return is_base(c) | F.coalesce(selector.score(c["x"]) >= limit, F.lit(False))

    return found.withColumns({"pii_base": F.transform(F.filter("pii_all", is_base), short), "pii_spans": F.transform(F.filter("pii_all", chosen), short)}).drop("pii_all", "pii_half")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones together, replaced by the kind in brackets."""
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("end"), c["kind"].alias("kind"))))

    def step(acc: Column, c: Column) -> Column:
        end = -c["end"]
        out = F.when(c["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, c["start"] - acc["at"]), F.lit("["), F.upper(c["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], end).alias("at"), out.alias("out"))

    whole = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
