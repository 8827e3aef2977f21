"""Merges that touch only the partitions of a table that their source has rows for (S15-S17 over S19)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.scratch import discard, shuffles_removed, written


def touched(source: DataFrame, by: Sequence[str]) -> list[tuple]:
    """The partitions that a source has rows for; they come to the driver, as the names of folders do."""
    return [tuple(r) for r in source.select(*by).distinct().collect()]


def _ends(source: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Two rows for each partition that a source has rows for, with the least and the greatest value of each key; a written table."""
    each = [F.struct(F.lit(True).alias("__any"), *(f(k).alias(k) for k in keys)) for f in (F.min, F.max)]
    return written(source.groupBy(*by).agg(F.array(*each).alias("__x")).select(*by, F.explode("__x").alias("__x")).select(*by, *(F.col(f"__x.{k}").alias(k) for k in keys)), "merge-ends")


def _in(by: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether a row lies in one of the partitions; a filter on partition columns only, so that other folders are not listed or read."""

    def one(column: str, wanted: set) -> Column:
        known = sorted((v for v in wanted if v is not None), key=str)
        held = F.col(column).isin(known) if known else F.lit(False)
        return held | F.col(column).isNull() if None in wanted else held

    if not values:
        return F.lit(False)
    each = reduce(lambda a, b: a & b, (one(c, {v[i] for v in values}) for i, c in enumerate(by)))
    if len(by) == 1:
        return each
    exact = reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(x)) for c, x in zip(by, v, strict=True))) for v in values))
    return each & exact


def read_partitions(spark: SparkSession, path: str, like: DataFrame, by: Sequence[str], values: Sequence[tuple]) -> DataFrame:
    """The rows of some partitions, with the columns and types of ``like``; none if the table is not there yet."""
    try:
        return spark.read.schema(like.schema).parquet(path).where(_in(by, values)).select(*like.columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def _joined(source: DataFrame, target: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of ``source`` against ``target`` whose columns are renamed to __t_*; nulls match nulls."""
    other = target.withColumnsRenamed({c: f"__t_{c}" for c in target.columns})
    return source.join(other, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__t_{k}")) for k in keys)), how)


def _near(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows whose keys lie between the source's least and greatest, or are null: a filter that Parquet's statistics can use."""
    ends = source.agg(*(f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    for i, k in enumerate(keys):
        if ends[f"lo_{i}"] is not None:
            target = target.where(F.col(k).isNull() | F.col(k).between(ends[f"lo_{i}"], ends[f"hi_{i}"]))
    return target


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], by: Sequence[str], how: str = "insert") -> DataFrame:
    """Merge ``source`` into the Parquet table at ``path``, partitioned by ``by``; returns counts by partition.

    ``how`` is "insert" (rows whose key the table holds are ignored) or "upsert" (they
    replace a row that differs). Keys match within a partition only, so ``by`` must follow
    from the key; null keys match each other, and of several source rows with one key the
    least by all columns counts. A second run of the same merge therefore changes nothing,
    also after a run that broke off.

    Only touched partitions are read, and of them what may hold keys between the source's
    least and greatest. The source, which is computed twice, and the table's keys meet in
    one aggregation, so that a record is shuffled once. New rows are appended to theirs, whose files stay;
    a partition is rewritten only if one of its rows is replaced. The result has
    ``by``, inserted, updated, ignored, rewritten; it is written, and the merge's other
    tables are deleted. Of ignored rows they hold the partition only.
    """
    if how not in ("insert", "upsert"):
        raise ValueError(f"how must be insert or upsert, not {how}")
    match = [*keys, *(c for c in by if c not in keys)]
    own = [k for k in keys if k not in by]
    ends = _ends(source, by, own)
    target = read_partitions(spark, path, source, by, touched(ends, by))
    rest = [c for c in source.columns if c not in match]
    row = F.struct(*rest, F.lit(True).alias("__any"))
    new = source.select(*match, row.alias("__s"), F.lit(None).cast("boolean").alias("__here"))
    held = _near(ends, target, own).select(*match, *((row.alias("__t"),) if how == "upsert" else ()), F.lit(True).alias("__here"))
    both = new.unionByName(held, allowMissingColumns=True).groupBy(*match).agg(F.min("__s").alias("__s"), F.max("__here").alias("__here"), *((F.min("__t").alias("__t"),) if how == "upsert" else ()))
    same = F.col("__s").eqNullSafe(F.col("__t")) if how == "upsert" else F.lit(True)
    action = F.when(F.col("__here").isNull(), "inserted").when(same, "ignored").otherwise("updated")
    value = lambda c: F.col(c) if c in match else F.col(f"__s.{c}")
    joined = both.where(F.col("__s").isNotNull()).withColumn("__action", action)
    acted = written(joined.select(*(F.col(c) if c in by else F.when(F.col("__action") != "ignored", value(c)).alias(c) for c in source.columns), "__action"), "merge-actions")
    changed = touched(acted.where("__action = 'updated'"), by)
    if changed:
        again = read_partitions(spark, path, source, by, changed)
        replaced = acted.where("__action = 'updated'").select(*match)
        kept = _joined(again, replaced, match, "left_anti")
        rows = kept.unionByName(acted.where(_in(by, changed) & F.col("__action").isin("updated", "inserted")).drop("__action"))
        with shuffles_removed(spark):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    acted.where((F.col("__action") == "inserted") & ~F.coalesce(_in(by, changed), F.lit(False))).drop("__action").write.mode("append").partitionBy(*by).parquet(path)
    count = lambda a: F.count_if(F.col("__action") == a).alias(a)
    counts = written(acted.groupBy(*by).agg(count("inserted"), count("updated"), count("ignored")).withColumn("rewritten", F.col("updated") > 0), "merge-counts")
    discard(acted, ends)
    return counts
