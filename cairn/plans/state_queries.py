"""Queries over tables that deliveries change: merges by partition, additive states, sketches; with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import partitions, sketches
from cairn.plans import incremental
from cairn.plans import queries as core
from cairn.plans.queries import _query, _t
from cairn.sources import readers, sinks
from cairn.sources.scratch import scratch_path, written


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their price in cents, and the year that a table of them is partitioned by."""
    return _t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.year("o_orderdate").alias("annee"))


_ORDERS = "o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(year(o_orderdate) AS INTEGER) AS annee FROM orders), s AS (SELECT o_orderkey, cents + CASE WHEN annee = 1996 AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS cents, annee FROM o WHERE annee IN (1996, 1998))"


@_query(
    "merge_by_partition",
    f"""WITH {_ORDERS}, t AS (SELECT * FROM o WHERE o_orderkey % 4 <> 0),
    m AS (SELECT annee, o_orderkey, coalesce(s.cents, t.cents) AS cents, t.cents IS NULL AS new, s.cents IS NOT NULL AND t.cents IS NOT NULL AND s.cents <> t.cents AS changed, s.cents = t.cents AS same FROM t FULL JOIN s USING (annee, o_orderkey))
    SELECT annee, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, CASE WHEN annee IN (1996, 1998) THEN count(*) FILTER (new) END AS inserted, CASE WHEN annee IN (1996, 1998) THEN count(*) FILTER (changed) END AS updated,
           CASE WHEN annee IN (1996, 1998) THEN count(*) FILTER (same) END AS ignored, CASE WHEN annee IN (1996, 1998) THEN count(*) FILTER (changed) > 0 END AS rewritten FROM m GROUP BY annee""",
)
def merge_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of two years merged into a table by year; only one of the years has rows that differ."""
    o, path = _orders(spark, sf), scratch_path(spark, "orders-by-year")
    sinks.write_table(o.where("o_orderkey % 4 <> 0"), path, partition_by=["annee"])
    dearer = (F.col("annee") == 1996) & (F.col("o_orderkey") % 5 == 0)
    source = o.where("annee IN (1996, 1998)").withColumn("cents", F.col("cents") + dearer.cast("long"))
    counts = partitions.merge_partitions(spark, path, source, ["o_orderkey"], ["annee"], how="upsert")
    held = readers.read_table(spark, path).groupBy("annee").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    return held.join(counts, "annee", "left")


@_query("merge_replayed", f"WITH {_ORDERS} SELECT annee, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, CAST(0 AS BIGINT) AS inserted, count(*) AS ignored FROM o WHERE annee >= 1997 GROUP BY annee")
def merge_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows merged twice into a table that is not there at first, every third with a null in its key: nothing comes a second time."""
    o, path = _orders(spark, sf).where("annee >= 1997"), scratch_path(spark, "orders-by-year")
    source = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")))
    keys = ["o_orderkey", "o_custkey"]
    partitions.merge_partitions(spark, path, source, keys, ["annee"])
    counts = partitions.merge_partitions(spark, path, source, keys, ["annee"]).select("annee", "inserted", "ignored")
    return readers.read_table(spark, path).groupBy("annee").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")).join(counts, "annee")


@_query(
    "source_ledger_inserted",
    """WITH x AS (SELECT l_orderkey AS k, CAST(year(l_shipdate) AS INTEGER) AS annee, l_orderkey % 17 = 0 AS short FROM lineitem), f AS (SELECT k, min(annee) AS annee FROM x WHERE NOT short GROUP BY k),
    i AS (SELECT annee, count(*) AS n FROM f GROUP BY annee)
    SELECT 'deces-' || annee || '.txt' AS title, count(*) AS lignes_brutes, count(*) FILTER (NOT short) AS lignes_parsees, count(*) FILTER (short) AS lignes_rejetees, coalesce(max(i.n), 0) AS lignes_inserees, count(*) FILTER (NOT short) - coalesce(max(i.n), 0) AS lignes_ignorees
    FROM x LEFT JOIN i USING (annee) GROUP BY annee""",
)
def source_ledger_inserted(spark: SparkSession, sf: str) -> DataFrame:
    """Files of lines merged by their order into a table, the earliest file first, and what became of each file's lines."""
    year = F.year("l_shipdate").cast("string")
    line = F.when(F.col("l_orderkey") % 17 == 0, F.rpad(F.col("l_orderkey").cast("string"), 161, " ")).otherwise(F.rpad(F.col("l_orderkey").cast("string"), 176, " "))
    lines = _t(spark, sf, "lineitem").select(line.alias("value"), F.concat(F.lit("deces-"), year, F.lit(".txt")).alias("_file"))
    listing = lines.select(F.col("_file").alias("title")).distinct()
    path = scratch_path(spark, "records")
    parsed = lines.where(readers.valid_length("value")).select(F.trim(F.substring("value", 1, 80)).alias("nom"), F.col("_file").alias("_source_fichier"))
    partitions.merge_partitions(spark, path, parsed.withColumn("tranche", F.pmod(F.xxhash64("nom"), F.lit(8)).cast("int")), ["nom"], ["tranche"])
    return readers.ingest_ledger(listing, lines, inserted=readers.read_table(spark, path))


# additive states
def _delivered(spark: SparkSession, records: DataFrame, states: incremental.States) -> DataFrame:
    """The stored states of three deliveries, the second of which came twice."""
    path, part = scratch_path(spark, "states"), F.pmod(F.col("l_orderkey"), F.lit(3))
    for name, k in (("a", 0), ("b", 1), ("b", 1), ("c", 2)):
        incremental.deliver(spark, path, name, records.where(part == k), states)
    return incremental.stored(spark, path, states)


@_query("incremental_monthly", core.ORACLE["monthly_metrics"])
def incremental_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.by_month(_delivered(spark, core.records(spark, sf), incremental.AGES), core.LIMITS)


@_query("incremental_ages", core.ORACLE["age_month_metrics"])
def incremental_ages(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.by_age(_delivered(spark, core.records(spark, sf), incremental.AGES), core.LIMITS)


@_query("incremental_places", core.ORACLE["place_metrics"])
def incremental_places(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.by_place(_delivered(spark, core.records(spark, sf), incremental.PLACES), core.places(spark, sf), core.LIMITS)


@_query("incremental_cohorts", core.ORACLE["cohort_metrics"])
def incremental_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.by_cohort(_delivered(spark, core.born_records(spark, sf), incremental.COHORTS), core.LIMITS)


# sketches
@_query(
    "approximate_median",
    f"WITH {core._R} SELECT 'annee' AS niveau, CAST(annee AS VARCHAR) AS groupe, count(*) AS n, true AS within FROM r GROUP BY 2 UNION ALL SELECT 'lieu', code, count(*), true FROM r GROUP BY 2 UNION ALL SELECT 'tout', '', count(*), true FROM r",
)
def approximate_median(spark: SparkSession, sf: str) -> DataFrame:
    """Medians of years, of places and of all, merged from sketches stored by year and place, and whether their rank is within the bound."""
    r = core.records(spark, sf).select("annee_deces", "code_lieu_deces", "age_au_deces")
    states = written(sketches.quantile_states(r, ["annee_deces", "code_lieu_deces"], "age_au_deces"), "age-sketches")
    each = r.withColumns({"tout": F.lit("")})
    out = []
    for level, by in (("annee", "annee_deces"), ("lieu", "code_lieu_deces"), ("tout", "tout")):
        merged = sketches.merged_quantiles(states.withColumn("tout", F.lit("")), [by]).withColumn("v", sketches.quantile(0.5))
        gap = sketches.rank_gap(each, [by], "age_au_deces", merged, "v", 0.5)
        found = merged.join(gap, by).select(F.lit(level).alias("niveau"), F.col(by).cast("string").alias("groupe"), "n", (F.col("gap") <= sketches.RANK_ERROR).alias("within"))
        out.append(found)
    return out[0].unionByName(out[1]).unionByName(out[2])


@_query(
    "distinct_estimates",
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS annee, count(DISTINCT l_partkey) AS exact, true AS within FROM lineitem GROUP BY 1 UNION ALL SELECT NULL, count(DISTINCT l_partkey), true FROM lineitem",
)
def distinct_estimates(spark: SparkSession, sf: str) -> DataFrame:
    """Different parts of years and of all, merged from sketches stored by month, beside exact counts; within six standard errors."""
    lines = _t(spark, sf, "lineitem").select(F.year("l_shipdate").alias("annee"), F.month("l_shipdate").alias("mois"), "l_partkey")
    states = written(sketches.distinct_states(lines, ["annee", "mois"], "l_partkey"), "part-sketches")
    years = sketches.merged_distinct(states, ["annee"])
    all_ = sketches.merged_distinct(years.withColumn("annee", F.lit(None).cast("int")), ["annee"])
    guess = years.unionByName(all_).select(F.col("annee").alias("a"), sketches.distinct_estimate().alias("about"))
    exact = lines.rollup("annee").agg(F.count_distinct("l_partkey").alias("exact")).join(guess, F.col("annee").eqNullSafe(F.col("a")))
    return exact.select("annee", "exact", (F.abs(F.col("about") - F.col("exact")) <= 6 * sketches.HLL_ERROR * F.col("exact")).alias("within"))


@_query(
    "common_places",
    """WITH y AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS annee, l_partkey FROM lineitem), b AS (SELECT annee + 1 AS annee, l_partkey FROM y)
    SELECT annee, count(*) FILTER (y.l_partkey IS NOT NULL AND b.l_partkey IS NOT NULL) AS exact, count(*) AS exact_either, true AS within FROM y FULL JOIN b USING (annee, l_partkey) WHERE annee IN (SELECT annee FROM y INTERSECT SELECT annee FROM b) GROUP BY annee""",
)
def common_places(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that a year shares with the year before, from sketches of months merged to years, beside exact counts."""
    lines = _t(spark, sf, "lineitem").select(F.year("l_shipdate").alias("annee"), F.month("l_shipdate").alias("mois"), "l_partkey")
    months = written(sketches.set_states(lines, ["annee", "mois"], "l_partkey"), "part-sets")
    guess = sketches.common(sketches.merged_sets(months, ["annee"]), "annee")
    held = lines.select("annee", "l_partkey").distinct()
    both = held.unionByName(held.withColumn("annee", F.col("annee") + 1)).groupBy("annee", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    exact = both.groupBy("annee").agg(F.count_if(F.col("n") == 2).alias("exact"), F.count(F.lit(1)).alias("exact_either"))
    return exact.join(guess, "annee").select("annee", "exact", "exact_either", (F.abs(F.col("n_common") - F.col("exact")) <= 6 * sketches.THETA_ERROR * F.col("exact_either")).alias("within"))
