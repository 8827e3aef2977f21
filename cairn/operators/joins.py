"""Joins (J1-J12) and merges by join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import zfill
from cairn.sources.scratch import written

from . import ranges

#: A dimension of up to this many rows and bytes is broadcast; beyond it Spark picks the join.
SMALL_ROWS = 500_000
SMALL_BYTES = 32 << 20
#: So many brackets are compared with every row; more are joined by bins.
FEW_BRACKETS = 1_000


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: texts and binaries by their length, nested columns by that of their JSON, others as 8."""

    def size(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        return F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) if kind.startswith(("array", "map", "struct")) else F.lit(8)

    return reduce(lambda a, b: a + b, (size(n, k) for n, k in df.dtypes), F.lit(16))


def small(dim: DataFrame, rows: int | None = None) -> DataFrame:
    """The frame marked for broadcast if it has no more than SMALL_ROWS rows and SMALL_BYTES bytes, else as it is.

    Unless ``rows`` is known this looks at the frame, no further than that many rows.
    """
    if rows is None:
        seen = dim.select(row_bytes(dim).alias("b")).limit(SMALL_ROWS + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
        return F.broadcast(dim) if seen.n <= SMALL_ROWS and seen.b <= SMALL_BYTES else dim
    return F.broadcast(dim) if rows <= SMALL_ROWS else dim


def enrich(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, cols: Sequence[str], pad: int | None = None) -> DataFrame:
    """Columns of a dimension by left join; every row of df stays.

    With ``pad`` the dimension's key is zero-filled to that width. The dimension must
    have one row per key.
    """
    key = zfill(dim_key, pad) if pad else F.col(dim_key)
    side = dim.select(key.alias("__key"), *cols)
    return df.join(side, F.col(left_key) == F.col("__key"), "left").drop("__key")


def match_coverage(joined: DataFrame, probe_col: str) -> DataFrame:
    """``n_rows, n_matched, n_unmatched`` of a left join, in one pass."""
    return joined.agg(F.count(F.lit(1)).alias("n_rows"), F.count(probe_col).alias("n_matched"), F.count_if(F.col(probe_col).isNull()).alias("n_unmatched"))


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_anti")


def link(fact: DataFrame, agg: DataFrame, fact_key: str, agg_key: str, how: str = "inner") -> DataFrame:
    """Join on a key that is a string on one side and a number on the other."""
    side = agg.withColumn("__key", F.col(agg_key).cast("string"))
    side = side.drop(*(c for c in agg.columns if c in fact.columns))
    return fact.join(side, F.col(fact_key).cast("string") == F.col("__key"), how).drop("__key")


def month_relation(calendar: DataFrame, key: str = "AnMois") -> DataFrame:
    """The months of a daily calendar, one row each."""
    return calendar.select(key).distinct()


def _number(df: DataFrame, c: str) -> Column:
    """A number as it is, a date or timestamp as a whole number."""
    kind = dict(df.dtypes)[c]
    return F.unix_date(c) if kind == "date" else F.unix_micros(c) if kind == "timestamp" else F.col(c)


def _as_number(df: DataFrame, c: str) -> Column:
    """A column as a double that keeps its order."""
    return _number(df, c).cast("double")


def bracket_join(df: DataFrame, col: str, rules: DataFrame, lo: str, hi: str, how: str = "left", few: int = FEW_BRACKETS) -> DataFrame:
    """Every rule whose closed bracket holds the value; ``how`` is left or inner.

    Up to ``few`` rules are broadcast and compared. More are binned: a rule belongs to the
    level whose bins, a power of two wide, are just wider than its bracket, so it lies in
    at most two of them, however wide it is. The different values look into their bin of
    each level that occurs, by an equal join, and rows find their value's rules. Values
    are numbers, dates or timestamps. Brackets that are empty or have a null end hold nothing.
    """
    if rules.limit(few + 1).count() <= few:
        return df.join(F.broadcast(rules), F.col(col).between(F.col(lo), F.col(hi)), how)
    at = lambda v: F.floor(v / F.pow(F.lit(2.0), F.col("__level"))).cast("double")
    first, last = _as_number(rules, lo), _as_number(rules, hi)
    level = F.greatest(F.ceil(F.log2(F.greatest(last - first, F.lit(1e-9)))), F.lit(-20)).cast("int")
    leveled = rules.where(F.col(lo) <= F.col(hi)).withColumn("__level", level)
    levels = sorted(r["__level"] for r in leveled.select("__level").distinct().collect())
    binned = leveled.withColumn("__bin", F.explode(F.array_distinct(F.array(at(first), at(last)))))
    value = df.select(F.col(col).alias("__value")).where(F.col("__value").isNotNull()).distinct()
    probes = value.withColumn("__level", F.explode(F.array(*map(F.lit, levels)))).withColumn("__bin", at(_as_number(value, "__value")))
    found = probes.join(binned, ["__level", "__bin"]).where(F.col("__value").between(F.col(lo), F.col(hi))).drop("__level", "__bin")
    return df.join(found, F.col(col) == F.col("__value"), how).drop("__value")


def bracket_totals(df: DataFrame, col: str, rules: DataFrame, lo: str, hi: str, value: str, n: str = "n", total: str = "total", rows: int = ranges.RANGE_ROWS) -> DataFrame:
    """How many rules have a closed bracket that holds the value, and the sum of their whole numbers ``value``.

    Gives what counting and summing over ``bracket_join`` would, without a row for each pair,
    of which there are as many as rows times brackets where these overlap. Along the order
    of all ends and different values a rule is added at its lower end and taken away after
    its upper one; ranges of the order are summed up each by itself and start with the
    totals of those before. Every row of df stays; without a rule both are 0.
    """

    def points(frame: DataFrame, c: str, side: int, sign: int) -> DataFrame:
        own = F.col(value).cast("long") * sign if sign else F.lit(0).cast("long")
        found = frame.select(_number(frame, c).alias("__at"), own.alias("__w")).where("__at IS NOT NULL")
        return found.groupBy("__at").agg(F.count(F.lit(1)).alias("__n"), F.coalesce(F.sum("__w"), F.lit(0)).alias("__w")).select("__at", F.lit(side).alias("__side"), (F.col("__n") * sign).alias("__n"), "__w")

    known = rules.where(F.col(lo) <= F.col(hi))
    held = written(points(known, lo, 0, 1).unionByName(points(df, col, 1, 0)).unionByName(points(known, hi, 2, -1)), "bracket-ends")
    dealt = ranges.dealt(held, "__at", ranges.boundaries(held, "__at", rows), "__own")
    before = Window.orderBy("__own").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("__own").agg(F.sum("__n").alias("__n0"), F.sum("__w").alias("__w0")).select("__own", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("__n0", "__w0")))
    so_far = Window.partitionBy("__own").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.select("__own", "__at", "__side", F.sum("__n").over(so_far).alias("__n"), F.sum("__w").over(so_far).alias("__w")).where("__side = 1")
    found = run.join(F.broadcast(starts), "__own").select("__at", (F.col("__n") + F.col("__n0")).alias("__n"), (F.col("__w") + F.col("__w0")).alias("__w"))
    joined = df.withColumn("__x", _number(df, col)).join(found, F.col("__x") == F.col("__at"), "left")
    return joined.select(*df.columns, F.coalesce("__n", F.lit(0)).alias(n), F.coalesce("__w", F.lit(0)).alias(total))


def prior_period(df: DataFrame, keys: Sequence[str], period_col: str, shift: int, value: str, name: str | None = None) -> DataFrame:
    """The value of the same keys ``shift`` periods before; null where that period is missing."""
    name = name or f"{value}_prior"
    before = df.select(*keys, (F.col(period_col) + shift).alias(period_col), F.col(value).alias(name))
    return df.join(before, [*keys, period_col], "left")


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols), F.lit(True))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], dedupe_source: bool = True) -> tuple[DataFrame, DataFrame]:
    """Target plus the source rows whose key it does not hold, and the merge's counts.

    Null keys never match. With ``dedupe_source`` one row per key is inserted, the least
    by all columns.
    """
    new = source.join(target.select(*keys), list(keys), "left_anti")
    if dedupe_source:
        rest = [c for c in source.columns if c not in keys]
        new = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__x")).select(*keys, *(F.col(f"__x.{c}").alias(c) for c in rest)).select(*source.columns) if rest else new.distinct()
    counts = new.agg(F.count(F.lit(1)).alias("inserted")).join(source.agg(F.count(F.lit(1)).alias("staged")), how="cross")
    return target.unionByName(new), counts.select("inserted", (F.col("staged") - F.col("inserted")).alias("ignored"))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], delete_missing: bool = False) -> tuple[DataFrame, DataFrame]:
    """Source rows replace target rows that differ, new ones are added; and the merge's counts.

    A row counts as updated only if a column differs, nulls compared as values. Keys
    are unique on both sides; null keys match each other.
    """
    cols = [c for c in target.columns if c not in keys]
    joined = target.withColumn("__t", F.lit(True)).alias("t").join(source.withColumn("__s", F.lit(True)).alias("s"), _same("t", "s", keys), "full_outer")
    in_t, in_s = F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()
    action = F.when(~in_t, "inserted").when(~in_s, "deleted" if delete_missing else "kept").when(_same("t", "s", cols), "ignored").otherwise("updated")
    pick = lambda c: F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
    rows = joined.select(*(pick(c) for c in target.columns), action.alias("__action"))
    counts = rows.agg(*(F.count_if(F.col("__action") == a).alias(a) for a in ("inserted", "updated", "deleted", "ignored")))
    return rows.where("__action <> 'deleted'").drop("__action"), counts
