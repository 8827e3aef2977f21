"""Aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.numbers import ratio, stddev  # noqa: F401
from cairn.sources.scratch import written

DISTRIBUTION = {"count": lambda v: F.count(F.lit(1)), "avg": lambda v: F.round(F.avg(v), 1), "median": F.median, "approx_median": lambda v: F.percentile_approx(v, 0.5, 1000), "min": F.min, "max": F.max, "sum": F.sum}


def profile(df: DataFrame, by: Sequence[str], value: str | None = None, flags: Mapping[str, Column] | None = None, stats: Mapping[str, str] | None = None, more: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per group: ``stats`` maps output names to count, avg, median, approx_median, min, max or sum of ``value``; ``flags`` are conditions counted; ``more`` are other aggregates.

    Null keys form their own group.
    """
    aggs = [DISTRIBUTION[s](value).alias(n) for n, s in (stats or {"n": "count"}).items()]
    aggs += [F.count_if(p).alias(n) for n, p in (flags or {}).items()]
    return df.groupBy(*by).agg(*aggs, *(c.alias(n) for n, c in (more or {}).items()))


def grouped(df: DataFrame, by: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """One row per group."""
    return df.groupBy(*by).agg(*(c.alias(n) for n, c in aggs.items()))


def grand_total(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """One row (A9)."""
    return df.agg(*(c.alias(n) for n, c in aggs.items()))


def with_totals(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """Every row with totals over the whole frame; the totals are one row and are broadcast."""
    return df.crossJoin(F.broadcast(grand_total(df, aggs)))


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, nulls compared as values: the least by ``order_by``, then by all other columns (A10)."""
    rest = [*order_by, *(c for c in df.columns if c not in keys and c not in order_by)]
    if not rest:
        return df.distinct()
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__x"))
    return least.select(*(F.col(c) if c in keys else F.col(f"__x.{c}").alias(c) for c in df.columns))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def latest(df: DataFrame, keys: Sequence[str], order_col: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``order_col`` per key, ties by the greatest ``ties``."""
    rest = [order_col, *ties, *(c for c in df.columns if c not in (*keys, order_col, *ties))]
    most = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__x"))
    return most.select(*(F.col(c) if c in keys else F.col(f"__x.{c}").alias(c) for c in df.columns))


def distinct_count(df: DataFrame, by: Sequence[str], col: str, name: str = "n_distinct") -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct(col).alias(name))


def exact_median(df: DataFrame, by: Sequence[str], col: str, name: str = "median") -> DataFrame:
    return df.groupBy(*by).agg(F.median(col).alias(name))


def exact_quantile(df: DataFrame, by: Sequence[str], col: str, rank: float = 0.5, name: str = "quantile", values: int = 10_000, bins: int = 1024) -> DataFrame:
    """``by, name``: the exact quantile of a number, interpolated as ``percentile`` does, without a group's values in one task.

    The one or two places in a group's order that the quantile lies at are sought alone.
    Each pass counts the values of a place's range in ``bins`` bins and narrows the range
    to the values of the bin that holds the place, until no range has more than ``values``
    different values; these are counted and sorted. Groups with nulls only have a null.
    """
    known = df.select(*by, F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    own = [*by, "place", "part", "below"]

    def match(a: str, b: str) -> Column:
        return reduce(lambda x, y: x & y, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in by), F.lit(True))

    def inside(state: DataFrame, *more: Column) -> DataFrame:
        joined = known.alias("k").join(state.alias("s"), match("k", "s") & F.col("__v").between(F.col("lo"), F.col("hi")))
        return joined.groupBy(*(F.col(f"s.{c}").alias(c) for c in own), *more)

    def upto(order: str) -> Column:
        return F.col("below") + F.sum("c").over(Window.partitionBy(*by, "place").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))

    at = (F.col("n") - 1) * F.lit(float(rank))
    seen = [F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.approx_count_distinct("__v").alias("d")]
    places = F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("place")
    state = written(known.groupBy(*by).agg(*seen, F.count(F.lit(1)).alias("n")).select(*by, places, (at - F.floor(at)).alias("part"), F.lit(0).cast("long").alias("below"), "lo", "hi", "d"), "quantile-ranges")
    while state.where((F.col("d") > values) & (F.col("lo") < F.col("hi"))).limit(1).count():
        width = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(1.0)
        counts = inside(state, F.least(F.floor((F.col("__v") - F.col("lo")) / width * bins), F.lit(bins - 1)).alias("b")).agg(*seen, F.count(F.lit(1)).alias("c"))
        held = counts.withColumn("e", upto("b")).where((F.col("e") > F.col("place")) & (F.col("e") - F.col("c") <= F.col("place")))
        state = written(held.withColumn("below", F.col("e") - F.col("c")).select(*state.columns), "quantile-ranges")
    each = inside(state, F.col("__v").alias("v")).agg(F.count(F.lit(1)).alias("c")).withColumn("e", upto("v"))
    picked = each.where((F.col("e") > F.col("place")) & (F.col("e") - F.col("c") <= F.col("place"))).groupBy(*by).agg(F.min("v").alias("a"), F.max("v").alias("b"), F.first("part").alias("part"))
    found = picked.select(*by, (F.col("a") * (1 - F.col("part")) + F.col("b") * F.col("part")).alias(name))
    return df.select(*by).distinct().alias("k").join(found.alias("s"), match("k", "s"), "left").select(*(F.col(f"k.{c}") for c in by), name)


def mean_of_means(df: DataFrame, by: Sequence[str], inner: Sequence[str], value: str, name: str = "mean") -> DataFrame:
    """The average of the inner groups' averages."""
    return df.groupBy(*by, *inner).agg(F.avg(value).alias("__m")).groupBy(*by).agg(F.avg("__m").alias(name))


def argmax_group(df: DataFrame, by: Sequence[str], label: str, value: Column, name: str = "label") -> DataFrame:
    """The label whose aggregate ``value`` is largest, ties to the least label."""
    each = df.groupBy(*by, label).agg(value.alias("__v"))
    return each.groupBy(*by).agg(F.min(F.struct((-F.col("__v")).alias("v"), F.col(label).alias("l")))["l"].alias(name), F.max("__v").alias("value"))


def max_of_totals(df: DataFrame, by: Sequence[str], inner: Sequence[str], value: Column | None = None, name: str = "max_total") -> DataFrame:
    """The largest total of the inner groups."""
    total = F.count(F.lit(1)) if value is None else value
    return df.groupBy(*by, *inner).agg(total.alias("__t")).groupBy(*by).agg(F.max("__t").alias(name))


def weighted_mean(value: str, weight: str, digits: int | None = None) -> Column:
    """sum(value * weight) / sum(weight), null for no weight."""
    return ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weight), digits=digits)


def rollup_levels(df: DataFrame, levels: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Measures at each level of a hierarchy and in total, with ``level`` (0 for the total)."""
    depth = len(levels)
    level = F.lit(depth) - sum((F.grouping(c).cast("int") for c in levels), F.lit(0))
    return df.rollup(*levels).agg(level.cast("int").alias("level"), *(c.alias(n) for n, c in measures.items()))


def pivot_matrix(df: DataFrame, row: str, col: str, value: Column, columns: Sequence[object], prefix: str = "") -> DataFrame:
    """One row per ``row``, one column per value of ``col`` in ``columns``."""
    out = df.groupBy(row).pivot(col, list(columns)).agg(value)
    return out.select(row, *(F.col(f"`{c}`").alias(f"{prefix}{c}") for c in columns))


def share(df: DataFrame, by: Sequence[str], value: str, digits: int = 2, name: str = "share") -> DataFrame:
    """Each row's share of its group's total in per cent."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn(name, ratio(value, total, 100, digits))
