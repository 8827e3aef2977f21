"""Projections, filters, keys, sorts and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.sources.scratch import written


def project(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """All columns in one projection."""
    return df.withColumns(dict(columns))


def split_rejects(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that fulfil the condition, and all others, unknown ones included."""
    ok = F.coalesce(cond, F.lit(False))
    return df.where(ok), df.where(~ok)


def valid_day(c: str) -> Column:
    """A day of eight characters that is not the sentinel 00000000."""
    return F.col(c).isNotNull() & (F.col(c) != "") & (F.col(c) != "00000000") & (F.length(c) == 8)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without nulls in the columns (P5)."""
    return df.dropna(subset=list(cols))


def in_range(df: DataFrame, col: str, lo: object, hi: object) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def where(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def indicators(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """A column of 0 or 1 for each predicate; unknown is 0 (P10)."""
    return df.withColumns({k: F.when(p, 1).otherwise(0) for k, p in predicates.items()})


def composite_key(parts: Sequence[str | Column], sep: str = "|", not_blank: Sequence[str] = ()) -> Column:
    """Parts joined by ``sep``; null if a part is null, or blank where it must not be."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    known = [c.isNotNull() for c in columns] + [F.col(c) != "" for c in not_blank]
    return F.when(reduce(lambda a, b: a & b, known), F.concat_ws(sep, *(c.cast("string") for c in columns)))


def key_coverage(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``key, n_rows, n_present, pct_present``, in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(k).alias(k) for k in keys))
    each = F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).alias("n_present")) for k in keys))
    return row.select("n_rows", F.explode(each).alias("x")).select("x.key", "n_rows", "x.n_present", F.when(F.col("n_rows") > 0, F.round(F.col("x.n_present") * 100.0 / F.col("n_rows"), 2)).alias("pct_present"))


def ordered(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*cols)


def with_position(df: DataFrame, cols: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Every row's place in the total order by ``cols``, from 1.

    Rows are sorted in ranges and written with their number in the range; each range
    starts after the rows of those before it. No task holds more than a range.
    """
    held = written(df.orderBy(*cols).withColumn("__id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__id", 33).alias("__part")
    sizes = held.groupBy(part).agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    starts = sizes.select("__part", "__first", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    out = held.withColumn("__part", part).join(starts, "__part")
    return out.withColumn(name, F.col("__id") - F.col("__first") + F.col("__before") + 1).select(*df.columns, name)


def top_k(df: DataFrame, by: Sequence[str | Column], k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The first k rows by descending ``by``, ties by ``ties`` ascending."""
    return df.orderBy(*(F.desc(c) if isinstance(c, str) else c for c in by), *ties).limit(k)


def first_by(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def latest_n(df: DataFrame, ts: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(ts), *ties).limit(n)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def row_numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
