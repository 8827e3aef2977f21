"""Data quality (Q1-Q14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.numbers import band_label


def compute_null_rates(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """``column, null_pct`` in one pass; an unknown column raises, an empty frame has 0.0 (Q1)."""
    names = list(columns or df.columns)
    unknown = [c for c in names if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    row = df.agg(F.count(F.lit(1)).alias("__n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in names))
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.when(F.col("__n") > 0, F.round(F.col(c) * 100.0 / F.col("__n"), digits)).otherwise(0.0).alias("null_pct")) for c in names))
    return row.select(F.explode(each).alias("x")).select("x.column", "x.null_pct")


def has_null(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether one of the columns that exist is null (Q2)."""
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns if c in df.columns), F.lit(False))


def check_not_null(df: DataFrame, columns: Sequence[str], flag_col: str = "_has_null") -> DataFrame:
    return df.withColumn(flag_col, has_null(df, columns))


def out_of_range(df: DataFrame, col: str, lo: float, hi: float) -> Column:
    """Whether the value is outside; null and a missing column are not (Q3)."""
    return F.coalesce(~F.col(col).between(lo, hi), F.lit(False)) if col in df.columns else F.lit(False)


def check_value_range(df: DataFrame, col: str, lo: float, hi: float, flag_col: str = "_out_of_range") -> DataFrame:
    return df.withColumn(flag_col, out_of_range(df, col, lo, hi))


def incoherent(first: str, second: str) -> Column:
    """Whether the first date is after the second; nulls are coherent (Q4)."""
    return F.coalesce(F.col(first) > F.col(second), F.lit(False))


def check_date_coherence(df: DataFrame, first: str, second: str, flag_col: str = "_date_incoherent") -> DataFrame:
    return df.withColumn(flag_col, incoherent(first, second))


def _flag(df: DataFrame, rule: Mapping) -> Column | None:
    kind = rule.get("type")
    if kind == "not_null":
        return has_null(df, rule["columns"])
    if kind == "range":
        return out_of_range(df, rule["column"], rule["min"], rule["max"])
    if kind == "date_coherence":
        return incoherent(*rule["columns"])
    return None


def compute_quality_report(df: DataFrame, rules: Mapping[str, Mapping], max_columns: int = 10) -> DataFrame:
    """``metric, value``: rows, invalid rows of each rule, null rates, and the share of rows without a flag (Q6).

    Rules of unknown type are skipped; an empty frame scores 100. One pass for all.
    """
    flags = {name: f for name, rule in rules.items() if (f := _flag(df, rule)) is not None}
    bad = reduce(lambda a, b: a | b, flags.values(), F.lit(False))
    names = df.columns[:max_columns]
    row = df.agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(~bad).alias("__ok"),
        *(F.count_if(f).alias(f"rule:{n}") for n, f in flags.items()), *(F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in names),
    )
    pct = lambda c: F.when(F.col("__n") > 0, F.round(F.col(c) * 100.0 / F.col("__n"), 2))
    parts = [("n_rows", F.col("__n").cast("double")), ("score", F.coalesce(pct("__ok"), F.lit(100.0)))]
    parts += [(f"invalid_{n}", F.col(f"`rule:{n}`").cast("double")) for n in flags]
    parts += [(f"null_pct_{c}", F.coalesce(pct(f"`null:{c}`"), F.lit(0.0))) for c in names]
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in parts))).alias("x")).select("x.*")


def reject_rates(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the count of each stage and the share of the first stage that each later one lost (Q7)."""
    names = list(stages)
    row = reduce(lambda a, b: a.crossJoin(b), (df.agg(F.count(F.lit(1)).alias(f"n_{n}")) for n, df in stages.items()))
    first = F.col(f"n_{names[0]}")
    return row.withColumns({f"pct_lost_{n}": F.when(first > 0, F.round((first - F.col(f"n_{n}")) * 100.0 / first, 2)) for n in names[1:]})


def distribution(df: DataFrame, by: str | Column, name: str) -> DataFrame:
    """Rows per value, nulls included (Q8, Q14)."""
    return df.groupBy((F.col(by) if isinstance(by, str) else by).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def decade_distribution(df: DataFrame, age: str) -> DataFrame:
    return distribution(df, band_label(age), "tranche")


def fill_report(df: DataFrame, flags: Sequence[str], filled: Sequence[str]) -> DataFrame:
    """How many rows have each flag, and the share of rows in which columns are filled (Q9)."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_rows"), *(F.count_if(F.col(f)).alias(f"n_{f.strip('_')}") for f in flags), *(F.when(n > 0, F.round(F.count(c) * 100.0 / n, 2)).alias(f"pct_{c}") for c in filled))


def reconciliation(aggregate: DataFrame, value: str, source: DataFrame) -> DataFrame:
    """The aggregate's sum against the source's rows (Q10, Q11)."""
    both = aggregate.agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("total_aggregate")).crossJoin(source.agg(F.count(F.lit(1)).alias("total_source")))
    return both.withColumn("gap", F.col("total_source") - F.col("total_aggregate"))


def year_ranges(dim: DataFrame, label: str, year: str) -> DataFrame:
    """Count and range of years per label (Q13)."""
    return dim.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))


def cardinality(fact: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of both and whether they are as many (Q11)."""
    both = fact.agg(F.count(F.lit(1)).alias("n_fact")).crossJoin(source.agg(F.count(F.lit(1)).alias("n_source")))
    return both.withColumn("equal", F.col("n_fact") == F.col("n_source"))


def _marked(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys, a hash of the key, and one of the whole row; values are compared as text, nulls as values."""
    text = lambda names: F.xxhash64(*(x for c in names for x in (F.col(c).cast("string"), F.col(c).isNull())))
    return df.select(*keys, text(keys).alias("__k"), text([*keys, *cols]).alias("__h"))


def _print() -> list[Column]:
    """An order-free fingerprint of the rows of a group: their number, and sum and exclusive or of their hashes."""
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col("__h").cast("decimal(20,0)")).alias("total"), F.bit_xor("__h").alias("bits")]


def fingerprints(df: DataFrame, by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """``by, n, total, bits``: a fingerprint of the rows of each group that does not depend on their order (Q10)."""
    rest = [c for c in (df.columns if cols is None else cols) if c not in by]
    return _marked(df, by, rest).groupBy(*by).agg(*_print())


def differing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None, fan: int = 64, levels: int = 2) -> DataFrame:
    """``keys, status``: keys whose rows are not the same in both frames: only_left, only_right or different (Q10, Q11).

    Rows are compared by fingerprints of ranges of the keys' hash: ``fan`` ranges first,
    then ``fan`` within each that differs, and so on for ``levels`` rounds or until most
    differ. Only the rows of the last ranges that differ are shuffled by key; equal frames
    are summed up and nothing more. Repeated keys count with all their rows, null keys as
    values. At most ``fan ** levels`` numbers of ranges come to the driver.
    """
    rest = [c for c in (left.columns if cols is None else cols) if c not in keys]
    sides = [_marked(df, keys, rest) for df in (left, right)]
    parts, bad = 1, [0]
    for _ in range(levels):
        parts *= fan
        at = F.pmod(F.col("__k"), F.lit(parts)).cast("int")
        prints = [s.groupBy(at.alias("__at")).agg(*_print()) for s in sides]
        same = F.col("l.n").eqNullSafe(F.col("r.n")) & F.col("l.total").eqNullSafe(F.col("r.total")) & F.col("l.bits").eqNullSafe(F.col("r.bits"))
        both = prints[0].alias("l").join(prints[1].alias("r"), F.col("l.__at") == F.col("r.__at"), "full").where(~same)
        bad = sorted(r[0] for r in both.select(F.coalesce("l.__at", "r.__at")).collect())
        sides = [s.where(at.isin(bad)) for s in sides] if bad else [s.limit(0) for s in sides]
        if not bad or len(bad) > parts // 2:
            break
    one, other = (s.groupBy(*keys).agg(*_print()) for s in sides)
    match = reduce(lambda a, b: a & b, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys))
    joined = one.alias("l").join(other.alias("r"), match, "full")
    status = F.when(F.col("r.n").isNull(), "only_left").when(F.col("l.n").isNull(), "only_right").when((F.col("l.n") != F.col("r.n")) | (F.col("l.total") != F.col("r.total")) | (F.col("l.bits") != F.col("r.bits")), "different")
    return joined.select(*(F.when(F.col("l.n").isNotNull(), F.col(f"l.{k}")).otherwise(F.col(f"r.{k}")).alias(k) for k in keys), status.alias("status")).where("status IS NOT NULL")
