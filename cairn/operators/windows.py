"""Window metrics.

Metrics over a whole table join one broadcast row of totals. Ordered metrics without
partition columns (W10, W11, W16, W17) are computed in ranges of the order
(``ranges``); ``few`` says that the series is short whatever the records, such as one
of months, and so needs no look at its size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cairn.functions.numbers import ratio, stddev

from . import ranges
from .aggregates import with_totals

_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def share_of_total(df: DataFrame, value: str, by: Sequence[str] | None = None, digits: int = 4, name: str = "pct_total", scale: float = 100.0) -> DataFrame:
    """W1."""
    if by:
        return df.withColumn(name, ratio(value, F.sum(value).over(Window.partitionBy(*by)), scale, digits))
    return with_totals(df, {"__t": F.sum(value)}).withColumn(name, ratio(value, "__t", scale, digits)).drop("__t")


def weighted_mean_over(df: DataFrame, value: str, weight: str, by: Sequence[str], digits: int = 1, name: str = "weighted_mean") -> DataFrame:
    """W2."""
    w = Window.partitionBy(*by)
    return df.withColumn(name, ratio(F.sum(F.col(value) * F.col(weight)).over(w), F.sum(weight).over(w), digits=digits))


def running_total(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], name: str = "cumul") -> DataFrame:
    """W3."""
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*_SO_FAR)))


def weighted_median(df: DataFrame, value: str, weight: str, by: Sequence[str], name: str = "weighted_median") -> DataFrame:
    """The least value at which the running weight reaches half of the group's."""
    total = F.sum(weight).over(Window.partitionBy(*by))
    held = running_total(df, weight, by, [value], "__c").withColumn("__t", total)
    return held.withColumn(name, F.min(F.when(F.col("__c") >= 0.5 * F.col("__t"), F.col(value))).over(Window.partitionBy(*by))).drop("__c", "__t")


def survival_index(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], digits: int = 4, name: str = "indice_survie") -> DataFrame:
    """1 - running share of the group's total."""
    total = F.sum(value).over(Window.partitionBy(*by))
    held = running_total(df, value, by, order, "__c").withColumn("__t", total)
    return held.withColumn(name, F.round(1 - ratio("__c", "__t"), digits)).drop("__c", "__t")


def zscore(col: str, mean: str, deviation: str, digits: int = 3) -> Column:
    """The z-score by columns that hold mean and deviation; null without spread."""
    return F.when(F.col(deviation) > 0, F.round((F.col(col) - F.col(mean)) / F.col(deviation), digits))


def with_few_spreads(df: DataFrame, col: str, keys: Sequence[str], ddof: int = 1) -> DataFrame:
    """Every row with ``__total`` of a column and, for each key, ``__m_<key>, __s_<key>``: mean and deviation of its group.

    All of them come from one pass over df with grouping sets, as one broadcast row that
    holds a map per key. Keys must not be null and must take few values, such as ages.
    """
    wanted = [[k] for k in keys] + [[]]
    aggs = (F.sum(col).alias("__t"), F.avg(col).alias("__m"), stddev(col, ddof).alias("__s"))
    sets = df.groupingSets(wanted, *keys).agg(*aggs, *(F.grouping(k).alias(f"__g_{k}") for k in keys))
    entry = lambda k: F.when(F.col(f"__g_{k}") == 0, F.struct(F.col(k), F.struct("__m", "__s")))
    total = F.max(F.when(reduce(lambda a, b: a & b, (F.col(f"__g_{k}") == 1 for k in keys)), F.col("__t")))
    row = sets.agg(total.alias("__total"), *(F.map_from_entries(F.collect_list(entry(k))).alias(f"__of_{k}") for k in keys))
    held = df.crossJoin(F.broadcast(row))
    out = {f"{p}_{k}": F.col(f"__of_{k}")[F.col(k)][p] for k in keys for p in ("__m", "__s")}
    return held.withColumns(out).drop(*(f"__of_{k}" for k in keys))


def zscore_flag(df: DataFrame, col: str, by: Sequence[str] | None = None, threshold: float = 2.5, ddof: int = 1, default: float | None = None, z_col: str | None = None, flag_col: str | None = "anomalie", digits: int = 3) -> DataFrame:
    """z-score over a group or the whole table, and whether its size is above ``threshold``.

    Without spread z is ``default`` (null: no flag). Leave out a column by naming it None.
    """
    if by:
        # groups can hold most of the rows: they are summed up before the exchange and joined back
        sums = df.groupBy(*(F.col(c).alias(f"__by_{c}") for c in by)).agg(F.avg(col).alias("__m"), stddev(col, ddof).alias("__s"))
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by))
        held = df.join(sums, same).drop(*(f"__by_{c}" for c in by))
    else:
        held = with_totals(df, {"__m": F.avg(col), "__s": stddev(col, ddof)})
    z = F.when(F.col("__s") > 0, F.round((F.col(col) - F.col("__m")) / F.col("__s"), digits))
    held = held.withColumn("__z", z if default is None else F.coalesce(z, F.lit(float(default))))
    out = {name: c for name, c in ((z_col, F.col("__z")), (flag_col, F.coalesce(F.abs("__z") > threshold, F.lit(False)))) if name}
    return held.withColumns(out).drop("__m", "__s", "__z")


def period_change(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], abs_col: str | None = "variation", pct_col: str | None = "variation_pct", digits: int = 2, strict: bool = False) -> DataFrame:
    """Change against the previous row of the group, absolute and in per cent.

    With ``strict`` the previous row counts only if the last order column is one less.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    before = F.lag(value).over(w)
    if strict:
        before = F.when(F.lag(order[-1]).over(w) == F.col(order[-1]) - 1, before)
    held = df.withColumn("__b", before)
    out = {name: c for name, c in ((abs_col, F.col(value) - F.col("__b")), (pct_col, ratio(F.col(value) - F.col("__b"), "__b", 100, digits))) if name}
    return held.withColumns(out).drop("__b")


def _ordered(df: DataFrame, order: str, by: Sequence[str], few: bool, columns: ranges.Columns, across: Callable[..., DataFrame], before: float, after: float = 0) -> DataFrame:
    """Window columns within groups, over a short series, or across ranges of the whole order."""
    if by or few:
        return df.withColumns(dict(columns(Window.partitionBy(*by).orderBy(order))))
    return across(df, order, columns, before, after)


def moving_average(df: DataFrame, value: str, order: str, rows: int = 12, by: Sequence[str] = (), digits: int = 1, name: str = "moyenne_mobile", few: bool = False) -> DataFrame:
    """The mean of the last ``rows`` rows."""
    return _ordered(df, order, by, few, lambda w: {name: F.round(F.avg(value).over(w.rowsBetween(1 - rows, 0)), digits)}, ranges.over_rows, rows - 1)


def calendar_moving_average(df: DataFrame, value: str, month_index: str, months: int = 12, by: Sequence[str] = (), digits: int = 1, name: str = "moyenne_mobile_cal", few: bool = False) -> DataFrame:
    """The mean over the last ``months`` calendar months; missing months do not count."""
    return _ordered(df, month_index, by, few, lambda w: {name: F.round(F.avg(value).over(w.rangeBetween(1 - months, 0)), digits)}, ranges.over_values, months - 1)


def seasonality_index(df: DataFrame, value: str, year: str, months: int = 12, strict: bool = False, digits: int = 3, name: str = "indice_saisonnalite") -> DataFrame:
    """Value over the year's rounded monthly mean; partial years divide by 12 too unless ``strict``."""
    w = Window.partitionBy(year)
    n = F.count(value).over(w) if strict else F.lit(months)
    return df.withColumn("__m", F.round(F.sum(value).over(w) / n, 1)).withColumn(name, ratio(value, "__m", 1, digits)).drop("__m")


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    side = right.withColumnsRenamed({c: f"__k_{c}" for c in on})
    return left.join(side, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in on))).drop(*(f"__k_{c}" for c in on))


def rank_by(df: DataFrame, col: str, by: Sequence[str] = (), descending: bool = True, name: str = "rang", range_rows: int = ranges.RANGE_ROWS, few: bool | None = None) -> DataFrame:
    """Dense rank of a number (W14), nulls last.

    A frame of up to ``range_rows`` rows (``few``, if known) is one window. Otherwise the
    different values of the groups are numbered within ranges that hold about as many of
    them each, however they are distributed, and each range starts after the counts of
    the group's ranges before it; rows get their value's number by a join. No task holds
    all values of a group, or all rows of a value.
    """
    order = F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()
    if ranges.holds_at_most(df, range_rows) if few is None else few:
        return df.withColumn(name, F.dense_rank().over(Window.partitionBy(*by).orderBy(order)).cast("int"))
    values = df.select(*by, col).distinct()
    ends = ranges.boundaries(values, col, range_rows)
    last = len(ends) + 2
    cut = ranges.dealt(values, col, ends, "__at")
    cut = cut.withColumn("__at", F.when(F.col("__at") < 0, last).otherwise(F.lit(last - 1) - F.col("__at") if descending else F.col("__at")))
    counts = cut.groupBy(*by, "__at").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*by).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select(*by, "__at", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__b"))
    own = cut.withColumn("__r", F.row_number().over(Window.partitionBy(*by, "__at").orderBy(order)))
    ranks = _null_safe_join(own, start, [*by, "__at"]).select(*by, col, (F.col("__r") + F.col("__b")).cast("int").alias(name))
    return _null_safe_join(df, ranks, [*by, col])


def survival_probability(df: DataFrame, by: Sequence[str], age: str, value: str, digits: int = 4) -> DataFrame:
    """Running total up to each age, its share and what is left of 1."""
    held = running_total(df, value, by, [age], "cumul").withColumn("__t", F.sum(value).over(Window.partitionBy(*by)))
    return held.withColumns({"part_cumul": ratio("cumul", "__t", 1, digits), "probabilite_survie": F.round(1 - ratio("cumul", "__t"), digits)}).drop("__t")


def neighbour_mean(df: DataFrame, order: str, value: str, radius: int = 3, by: Sequence[str] = (), digits: int = 2, name: str = "moyenne_voisins", few: bool = False) -> DataFrame:
    """The mean of the rows within ``radius`` of the order column, without the row itself."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        w = w.rangeBetween(-radius, radius)
        return {name: ratio(F.sum(value).over(w) - F.coalesce(F.col(value), F.lit(0)), F.count(value).over(w) - F.col(value).isNotNull().cast("int"), digits=digits)}

    return _ordered(df, order, by, few, columns, ranges.over_values, radius, radius)


def previous_group_gap(df: DataFrame, order: str, value: str, digits: int = 2, name: str = "ecart_precedent", few: bool = False) -> DataFrame:
    """Difference to the group before in order."""
    return _ordered(df, order, (), few, lambda w: {name: F.round(F.col(value) - F.lag(value).over(w), digits)}, ranges.over_rows, 1)


def control_limits(df: DataFrame, value: str, k: float = 2, digits: int = 2) -> DataFrame:
    """Mean and population limits of the whole table on every row."""
    held = with_totals(df, {"__m": F.avg(value), "__s": F.stddev_pop(value)})
    return held.withColumns({"limite_basse": F.round(F.col("__m") - k * F.col("__s"), digits), "limite_haute": F.round(F.col("__m") + k * F.col("__s"), digits)}).drop("__m", "__s")


def is_monotone(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Per group, how often a value is above the one before (Q12)."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__up", (F.col(value) > before).cast("int")).groupBy(*by).agg(F.coalesce(F.sum("__up"), F.lit(0)).alias("n_rises"))


