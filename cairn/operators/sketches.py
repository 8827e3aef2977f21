"""Mergeable sketches of quantiles and of distinct values.

A state is a binary column that a table can hold: one per group at a fine grain. States
of coarser groups are merged from it, without the rows that it was made from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch; its rank is off by less than RANK_ERROR in all but a few of a million cases.
KLL_K = 800
RANK_ERROR = 0.01
#: Logarithm of the size of sketches of distinct values. Their relative standard errors:
LG_K = 12
HLL_ERROR = 1.04 / 2 ** (LG_K / 2)
THETA_ERROR = 1 / 2 ** (LG_K / 2)


def quantile_states(df: DataFrame, by: Sequence[str], col: str, k: int = KLL_K) -> DataFrame:
    """``by, n, sketch``: how many integers each group has, and their quantile sketch; groups with nulls only have none."""
    known = df.where(F.col(col).isNotNull())
    return known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(F.col(col).cast("long"), k).alias("sketch"))


def merged_quantiles(states: DataFrame, by: Sequence[str], k: int = KLL_K) -> DataFrame:
    """The states of coarser groups."""
    return states.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def quantile(rank: float, sketch: str = "sketch") -> Column:
    """The value of about this rank (0 to 1)."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(rank)))


def rank_gap(df: DataFrame, by: Sequence[str], col: str, guess: DataFrame, value: str, rank: float) -> DataFrame:
    """``by, gap``: how far a guessed quantile is from the wanted rank, counted over the rows (0 if a row of this rank has the value)."""
    both = df.where(F.col(col).isNotNull()).join(guess.select(*by, F.col(value).alias("__v")), list(by))
    n = F.count(F.lit(1))
    below, upto = F.count_if(F.col(col) < F.col("__v")) / n, F.count_if(F.col(col) <= F.col("__v")) / n
    return both.groupBy(*by).agg(F.greatest(below - rank, F.lit(rank) - upto, F.lit(0.0)).alias("gap"))


def distinct_states(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """``by, sketch``: a sketch of each group's different values, for unions along a hierarchy."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, LG_K).alias("sketch"))


def merged_distinct(states: DataFrame, by: Sequence[str]) -> DataFrame:
    return states.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def set_states(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """``by, sketch``: a sketch of each group's different values, for intersections as well."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(col, LG_K).alias("sketch"))


def merged_sets(states: DataFrame, by: Sequence[str]) -> DataFrame:
    return states.groupBy(*by).agg(F.theta_union_agg("sketch", LG_K).alias("sketch"))


def common(states: DataFrame, period: str, shift: int = 1) -> DataFrame:
    """``period, n_common, n_either``: about how many values a period shares with that ``shift`` before, and how many the two have in all.

    The error of ``n_common`` is relative to ``n_either``.
    """
    before = states.select((F.col(period) + shift).alias(period), F.col("sketch").alias("__before"))
    both = states.join(before, period)
    estimate = lambda c: F.theta_sketch_estimate(c)
    return both.select(period, estimate(F.theta_intersection("sketch", "__before")).alias("n_common"), estimate(F.theta_union("sketch", "__before")).alias("n_either"))
