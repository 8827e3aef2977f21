"""Queries over the driver's tables and their DuckDB equivalents.

Shipped lines stand for records: quantity is the age, return flag the sex, supplier
the place, order date the date of birth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import dates, numbers, rules, text
from cairn.operators import aggregates, joins, quality, ranges, rows, windows
from cairn.plans import gold, layers, measures, monitoring
from cairn.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
LIMITS = gold.Limits(centenarian=45, minor=8, senior=30)
GENERATIONS = ((1990, 1995, "A"), (1996, 1997, "B"), (1998, 2003, "C"))

_R = """r AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS age, CASE l_returnflag WHEN 'R' THEN 'M' WHEN 'A' THEN 'F' END AS sexe,
         CAST(l_shipdate AS DATE) AS d, CAST(year(l_shipdate) AS INTEGER) AS annee, CAST(month(l_shipdate) AS INTEGER) AS mois, lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS code
  FROM lineitem)"""
_B = f"""{_R}, b AS (SELECT r.*, CAST(o_orderdate AS DATE) AS birth, CAST(year(o_orderdate) AS INTEGER) AS by_, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS bm,
  CASE WHEN year(o_orderdate) BETWEEN 1990 AND 1995 THEN 'A' WHEN year(o_orderdate) BETWEEN 1996 AND 1997 THEN 'B' WHEN year(o_orderdate) BETWEEN 1998 AND 2003 THEN 'C' ELSE 'Inconnue' END AS gen
  FROM r JOIN orders ON l_orderkey = o_orderkey)"""
_SEX = "CAST(count(*) FILTER (sexe = 'M') AS BIGINT) AS nb_hommes, CAST(count(*) FILTER (sexe = 'F') AS BIGINT) AS nb_femmes, count(*) FILTER (age >= 45) AS nb_centenaires, count(*) FILTER (age < 8) AS nb_mineurs"
_PCT = "CASE WHEN nb_hommes + nb_femmes > 0 THEN round(nb_hommes * 100.0::DOUBLE / (nb_hommes + nb_femmes), 2) END AS pct_hommes, CASE WHEN nb_hommes + nb_femmes > 0 THEN round(nb_femmes * 100.0::DOUBLE / (nb_hommes + nb_femmes), 2) END AS pct_femmes"


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Shipped lines as records."""
    day = F.col("l_shipdate").cast("date")
    return _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("age_au_deces"), text.map_codes("l_returnflag", {"R": "M", "A": "F"}).alias("sexe"),
        day.alias("date_deces"), dates.year_of(day).alias("annee_deces"), dates.month_of(day).alias("mois_deces"), text.zfill("l_suppkey").alias("code_lieu_deces"),
    )


def born_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records with a date of birth."""
    orders = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("date_naissance"))
    return records(spark, sf).join(orders, "l_orderkey")


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as places within nations and regions."""
    nation = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    joined = joins.enrich(_t(spark, sf, "supplier"), nation, "s_nationkey", "n_nationkey", ["n_name", "r_name"])
    return joined.select(F.col("s_suppkey").cast("string").alias("id_commune"), F.col("s_name").alias("commune"), F.col("n_name").alias("departement"), F.col("r_name").alias("region"), F.col("s_acctbal").alias("population_commune"), (F.col("s_acctbal") / 100).alias("superficie_commune"))


def model(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    born = born_records(spark, sf)
    return {
        "fact": measures.fact_model(born, GENERATIONS),
        "by_month": gold.by_month(records(spark, sf), LIMITS),
        "by_place": gold.by_place(records(spark, sf), places(spark, sf), LIMITS),
        "by_cohort": gold.by_cohort(born, LIMITS),
        "by_age": gold.by_age(records(spark, sf), LIMITS),
    }


_MONTHLY = f"""{_R}, g AS (
  SELECT annee, mois, annee * 100 + mois AS "AnMois", count(*) AS nb_deces, round(avg(age), 1) AS age_moyen, median(age) AS age_median, min(age) AS age_min, max(age) AS age_max, {_SEX}
  FROM r GROUP BY annee, mois), m AS (
  SELECT *, {_PCT}, nb_deces - lag(nb_deces) OVER wm AS v, lag(nb_deces) OVER wm AS prev,
         round(avg(nb_deces) OVER (ORDER BY "AnMois" ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 1) AS moyenne_mobile_12m,
         round(CAST(sum(nb_deces) OVER (PARTITION BY annee) AS DOUBLE) / 12, 1) AS my,
         avg(nb_deces) OVER () AS mg, stddev_samp(nb_deces) OVER () AS sg
  FROM g WINDOW wm AS (PARTITION BY mois ORDER BY annee)), monthly AS (
  SELECT annee, mois, CAST("AnMois" AS INTEGER) AS "AnMois", nb_deces, age_moyen, age_median, age_min, age_max, nb_hommes, nb_femmes, pct_hommes, pct_femmes, nb_centenaires, nb_mineurs,
         CAST(v AS INTEGER) AS variation_vs_n_1, round(CAST(v AS DOUBLE) * 100 / prev, 2) AS variation_pct, moyenne_mobile_12m,
         round(nb_deces / my, 3) AS indice_saisonnalite, round((nb_deces - mg) / sg, 3) AS z_score, coalesce(abs(round((nb_deces - mg) / sg, 3)) > 2.0, false) AS anomalie_flag
  FROM m)"""
_PLACE = f"""{_R}, pl AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS id, s_name AS commune, n_name AS departement, r_name AS region, s_acctbal AS pop, s_acctbal / 100 AS area
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey), g AS (
  SELECT code, count(*) AS nb_deces, round(avg(age), 1) AS age_moyen_deces, median(age) AS age_median_deces, min(age) AS age_min, max(age) AS age_max, {_SEX}, count(*) FILTER (age >= 30) AS seniors
  FROM r GROUP BY code), k AS (
  SELECT coalesce(id, code) AS id_commune, pop AS population_commune, nb_deces, CASE WHEN pop >= 50 THEN round(nb_deces / pop * 1000, 4) END AS taux_mortalite, age_moyen_deces, age_median_deces, age_min, age_max,
         nb_hommes, nb_femmes, {_PCT}, nb_centenaires, nb_mineurs, round(seniors * 100.0::DOUBLE / nb_deces, 2) AS indice_vieillissement, CASE WHEN area > 0 THEN round(nb_deces / area, 4) END AS densite_deces
  FROM g LEFT JOIN pl ON id = code), place AS (
  SELECT *, coalesce(abs(round((taux_mortalite - avg(taux_mortalite) OVER ()) / stddev_samp(taux_mortalite) OVER (), 3)) > 2.5, false) AS anomalie_mortalite FROM k)"""


@_query("monthly_metrics", f"WITH {_MONTHLY} SELECT * FROM monthly")
def monthly_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.by_month(records(spark, sf), LIMITS)


@_query(
    "mart_monthly",
    f"""WITH {_MONTHLY} SELECT *, CAST(ceil(mois / 3.0) AS INTEGER) AS trimestre, annee || ' T' || CAST(ceil(mois / 3.0) AS INTEGER) AS libelle_trimestre, CASE WHEN mois <= 6 THEN 1 ELSE 2 END AS semestre,
    CASE WHEN mois IN (12, 1, 2) THEN 'Hiver' WHEN mois <= 5 THEN 'Printemps' WHEN mois <= 8 THEN 'Ete' ELSE 'Automne' END AS saison,
    ['Janvier','Fevrier','Mars','Avril','Mai','Juin','Juillet','Aout','Septembre','Octobre','Novembre','Decembre'][mois] AS libelle_mois FROM monthly""",
)
def mart_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.mart_monthly(monthly_metrics(spark, sf))


@_query(
    "age_month_metrics",
    f"""WITH {_R}, g AS (SELECT age, CAST(annee * 100 + mois AS INTEGER) AS id_date, count(*) AS nb_deces, {_SEX} FROM r GROUP BY 1, 2), k AS (
    SELECT *, {_PCT}, sum(nb_deces) OVER () AS t, sum(nb_deces) OVER w AS tm, sum(age * nb_deces) OVER w AS am, sum(nb_deces) OVER (PARTITION BY id_date ORDER BY age) AS c, avg(nb_deces) OVER w AS m, stddev_samp(nb_deces) OVER w AS s
    FROM g WINDOW w AS (PARTITION BY id_date))
    SELECT age, id_date, age || '|' || id_date AS key_age, nb_deces, round(CAST(nb_deces AS DOUBLE) * 100 / t, 4) AS pct_total, nb_hommes, nb_femmes, pct_hommes, pct_femmes,
           CASE WHEN nb_femmes > 0 THEN round(CAST(nb_hommes AS DOUBLE) / nb_femmes, 3) END AS ratio_h_f, round(CAST(am AS DOUBLE) / tm, 1) AS age_moyen,
           min(CASE WHEN c >= 0.5 * tm THEN age END) OVER (PARTITION BY id_date) AS age_median, nb_centenaires, nb_mineurs, round(1 - CAST(c AS DOUBLE) / tm, 4) AS indice_survie,
           coalesce(CASE WHEN s > 0 THEN abs(round((nb_deces - m) / s, 3)) > 2.5 END, false) AS anomalie_distribution FROM k""",
)
def age_month_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.by_age(records(spark, sf), LIMITS)


@_query("place_metrics", f"WITH {_PLACE} SELECT * FROM place")
def place_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.by_place(records(spark, sf), places(spark, sf), LIMITS)


@_query("mart_place", f"WITH {_PLACE} SELECT place.*, commune, departement, region, area AS superficie_commune FROM place LEFT JOIN pl ON id = id_commune")
def mart_place(spark: SparkSession, sf: str) -> DataFrame:
    return gold.mart_place(place_metrics(spark, sf), places(spark, sf))


@_query(
    "cohort_metrics",
    f"""WITH {_B}, g AS (
    SELECT bm AS id_date, by_ AS annee_naissance, age, code AS id_commune, count(*) AS nb_deces, round(avg(age), 1) AS age_moyen_deces, median(age) AS age_median_deces, min(age) AS age_min, max(age) AS age_max, {_SEX},
           count(*) FILTER (age >= 30) AS seniors, min(annee) AS annee_deces_min, max(annee) AS annee_deces_max FROM b WHERE by_ BETWEEN 1850 AND 2025 GROUP BY 1, 2, 3, 4), k AS (
    SELECT *, {_PCT}, sum(nb_deces) OVER () AS t, avg(nb_deces) OVER (PARTITION BY age) AS ma, stddev_samp(nb_deces) OVER (PARTITION BY age) AS sa, avg(nb_deces) OVER (PARTITION BY annee_naissance) AS mc, stddev_samp(nb_deces) OVER (PARTITION BY annee_naissance) AS sc,
           lag(nb_deces) OVER (PARTITION BY annee_naissance, id_commune ORDER BY age, id_date) AS p FROM g)
    SELECT id_date, id_date || '|' || age || '|' || id_commune AS key_generation, annee_naissance, age, id_commune, nb_deces, round(CAST(nb_deces AS DOUBLE) * 100 / t, 5) AS pct_total, age_moyen_deces, age_median_deces, age_min, age_max,
           nb_hommes, nb_femmes, pct_hommes, pct_femmes, CASE WHEN nb_femmes > 0 THEN round(CAST(nb_hommes AS DOUBLE) / nb_femmes, 3) END AS ratio_h_f, nb_centenaires, nb_mineurs, annee_deces_min, annee_deces_max,
           coalesce(CASE WHEN sa > 0 THEN round((nb_deces - ma) / sa, 3) END, 0.0) AS surmortalite, round(CAST(nb_deces - p AS DOUBLE) * 100 / p, 2) AS tendance_mortalite, round(seniors * 100.0::DOUBLE / nb_deces, 2) AS indice_vieillissement,
           coalesce(CASE WHEN sc > 0 THEN abs(round((nb_deces - mc) / sc, 3)) > 2.5 END, false) AS anomalie_generation FROM k""",
)
def cohort_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.by_cohort(born_records(spark, sf), LIMITS)


_KEYS = f"""{_B}, f AS (SELECT l_orderkey, l_linenumber, age || '|' || (annee * 100 + mois) AS "key_aggAge", CAST(annee * 100 + mois AS VARCHAR) AS "key_aggTemporel", code AS "key_aggGeographie", bm || '|' || age || '|' || code AS "key_aggGeneration" FROM b)"""


@_query("fact_keys", f"WITH {_KEYS} SELECT * FROM f")
def fact_keys(spark: SparkSession, sf: str) -> DataFrame:
    return gold.with_keys(born_records(spark, sf)).select("l_orderkey", "l_linenumber", "key_aggAge", "key_aggTemporel", "key_aggGeographie", "key_aggGeneration")


@_query(
    "key_coverage",
    f"""WITH {_R}, u AS (SELECT unnest([{{'key': 'k_age', 'p': count(CASE WHEN sexe IS NOT NULL THEN age END)}}, {{'key': 'k_code', 'p': count(code)}}]) AS x, count(*) AS n FROM r)
    SELECT x.key AS key, n AS n_rows, x.p AS n_present, round(x.p * 100.0::DOUBLE / n, 2) AS pct_present FROM u""",
)
def key_coverage(spark: SparkSession, sf: str) -> DataFrame:
    keyed = records(spark, sf).withColumns({"k_age": rows.composite_key(["sexe", "age_au_deces"]), "k_code": rows.composite_key(["code_lieu_deces"], not_blank=["code_lieu_deces"])})
    return rows.key_coverage(keyed, ["k_age", "k_code"])


@_query("fact_to_agg_link", f"""WITH {_KEYS}, a AS (SELECT annee * 100 + mois AS k, count(*) AS nb_deces FROM r GROUP BY 1) SELECT "key_aggTemporel", nb_deces, count(*) AS n FROM f JOIN a ON CAST(k AS VARCHAR) = "key_aggTemporel" GROUP BY 1, 2""")
def fact_to_agg_link(spark: SparkSession, sf: str) -> DataFrame:
    fact = gold.with_keys(born_records(spark, sf)).select("key_aggTemporel")
    months = records(spark, sf).groupBy(dates.period_key("annee_deces", "mois_deces").alias("AnMois")).agg(F.count(F.lit(1)).alias("nb_deces"))
    return joins.link(fact, months, "key_aggTemporel", "AnMois").groupBy("key_aggTemporel", "nb_deces").agg(F.count(F.lit(1)).alias("n"))


@_query("fixed_width_roundtrip", "SELECT split_part(c_name, '#', 1) AS nom, split_part(c_name, '#', 2) AS prenoms, CAST(c_custkey AS VARCHAR) AS code, c_mktsegment AS segment FROM customer")
def fixed_width_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    line = F.concat(F.rpad(F.translate("c_name", "#", "*"), 80, " "), F.rpad(F.col("c_custkey").cast("string"), 12, " "), F.rpad("c_mktsegment", 12, " "))
    fields = readers.slice_fields(c.select(line.alias("value")).where(readers.valid_length("value", 100)), {"full": (0, 80), "code": (80, 92), "segment": (92, 104)})
    nom, prenoms = text.split_first("full")
    return fields.select(nom.alias("nom"), prenoms.alias("prenoms"), "code", "segment")


@_query(
    "clean_text",
    """SELECT c_custkey, upper(trim('  ' || c_name || ' ')) AS nom, nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, '') AS pays, c_name AS barre, CASE c_mktsegment WHEN 'MACHINERY' THEN 'M' WHEN 'FURNITURE' THEN 'F' END AS code,
    CASE WHEN c_nationkey > 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS lieu FROM customer""",
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    return c.select(
        "c_custkey", text.clean_text(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("nom"), text.blank_to_null(F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))).alias("pays"),
        text.strip_trailing(F.concat("c_name", F.lit("/"))).alias("barre"), text.map_codes("c_mktsegment", {"MACHINERY": "M", "FURNITURE": "F"}).alias("code"), text.zfill(F.when(F.col("c_nationkey") > 0, F.col("c_nationkey"))).alias("lieu"),
    )


@_query(
    "approx_dates",
    """WITH x AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS s, CAST(o_orderdate AS DATE) AS d, o_orderkey % 4 AS k FROM orders)
    SELECT o_orderkey, CAST(CASE k WHEN 0 THEN d WHEN 1 THEN date_trunc('month', d)::DATE WHEN 2 THEN date_trunc('year', d)::DATE END AS VARCHAR) AS jour, k IN (1, 2) AS approx,
    CASE WHEN k = 3 THEN -1 ELSE CAST(floor(date_diff('day', CASE k WHEN 0 THEN d WHEN 1 THEN date_trunc('month', d)::DATE ELSE date_trunc('year', d)::DATE END, DATE '2010-06-15') / 365.25) AS INTEGER) END AS age,
    CASE WHEN s[1:2] IN ('97', '98') THEN s[1:3] ELSE s[1:2] END AS departement FROM x""",
)
def approx_dates(spark: SparkSession, sf: str) -> DataFrame:
    s, k = F.date_format("o_orderdate", "yyyyMMdd"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, s).when(k == 1, F.concat(F.substring(s, 1, 6), F.lit("00"))).when(k == 2, F.concat(F.substring(s, 1, 4), F.lit("0000"))).otherwise(F.concat(F.substring(s, 1, 4), F.lit("1332")))
    x = _t(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    day = dates.approx_date("raw")
    age = F.coalesce(dates.age_years(day, F.lit("2010-06-15").cast("date")), F.lit(-1))
    return x.select("o_orderkey", day.cast("string").alias("jour"), dates.approx_flag("raw").alias("approx"), age.alias("age"), text.region_prefix("raw").alias("departement"))


@_query("reject_split", "SELECT o_orderstatus, count(*) FILTER (o_orderkey % 5 <> 0) AS kept, count(*) FILTER (o_orderkey % 5 = 0) AS rejected FROM orders GROUP BY 1")
def reject_split(spark: SparkSession, sf: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 10 == 0, "00000000")
    ok, bad = rows.split_rejects(_t(spark, sf, "orders").select("o_orderstatus", day.alias("day")), rows.valid_day("day"))
    both = rows.union_all([ok.withColumn("kept", F.lit(True)), bad.withColumn("kept", F.lit(False))])
    return both.groupBy("o_orderstatus").agg(F.count_if(F.col("kept")).alias("kept"), F.count_if(~F.col("kept")).alias("rejected"))


_L = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


@_query("dedup", f"SELECT {_L} FROM (SELECT {_L}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1")
def dedup(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.dedup(_t(spark, sf, "lineitem").select(*_L.split(", ")), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"])


@_query("duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.duplicates(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("latest_per_key", "SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.latest(_t(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey"), ["o_custkey"], "day", ["o_orderkey"]).withColumn("day", F.col("day").cast("string"))


_CUST = ["c_custkey", "c_name", "c_acctbal"]


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = _t(spark, sf, "customer").select(*_CUST)
    new = c.where("c_custkey % 3 <> 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 5 == 0, None).otherwise(F.col("c_acctbal")))
    return c.where("c_custkey % 2 = 0"), new


_BATCHES = "t AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0), s AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0)"


@_query("merge_insert_only", f"WITH {_BATCHES} SELECT * FROM t UNION ALL SELECT * FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM t)")
def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return joins.merge_insert_only(*_batches(spark, sf), ["c_custkey"])[0]


@_query("merge_upsert", f"WITH {_BATCHES} SELECT * FROM s UNION ALL SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM s)")
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return joins.merge_upsert(*_batches(spark, sf), ["c_custkey"])[0]


@_query(
    "merge_metrics",
    f"WITH {_BATCHES} SELECT count(*) FILTER (t.c_custkey IS NULL) AS inserted, count(*) FILTER (t.c_acctbal IS DISTINCT FROM s.c_acctbal AND t.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL) AS updated, count(*) FILTER (s.c_custkey IS NULL) AS deleted, count(*) FILTER (t.c_acctbal IS NOT DISTINCT FROM s.c_acctbal AND t.c_custkey = s.c_custkey) AS ignored FROM t FULL JOIN s USING (c_custkey)",
)
def merge_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return joins.merge_upsert(*_batches(spark, sf), ["c_custkey"], delete_missing=True)[1]


@_query(
    "age_bands",
    f"""WITH {_R} SELECT CASE WHEN age <= 17 THEN '0-17 ans' WHEN age <= 29 THEN '18-29 ans' WHEN age <= 44 THEN '30-44 ans' ELSE '45-59 ans' END AS tranche_age, (age // 5 * 5) || '-' || (age // 5 * 5 + 4) || ' ans' AS tranche_age_5_ans,
    CASE WHEN age <= 11 THEN 'Enfant' WHEN age <= 17 THEN 'Adolescent' ELSE 'Adulte' END AS categorie_age, age >= 18 AS majeur_flag, count(*) AS n FROM r GROUP BY ALL""",
)
def age_bands(spark: SparkSession, sf: str) -> DataFrame:
    bands = ["tranche_age", "tranche_age_5_ans", "categorie_age", "majeur_flag"]
    joined = joins.enrich(records(spark, sf).select("age_au_deces"), F.broadcast(layers.dim_age(spark)), "age_au_deces", "age", bands)
    return joined.groupBy(*bands).agg(F.count(F.lit(1)).alias("n"))


@_query(
    "calendar_labels",
    """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS id_date, monthname(o_orderdate) AS mois_libelle, strftime(o_orderdate, '%m') AS tri_mois, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semestre,
    CAST(week(o_orderdate) AS INTEGER) AS semaine, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Hiver' WHEN month(o_orderdate) <= 5 THEN 'Printemps' WHEN month(o_orderdate) <= 8 THEN 'Ete' ELSE 'Automne' END AS saison, dayname(o_orderdate) AS jour_semaine, dayofweek(o_orderdate) IN (0, 6) AS weekend, count(*) AS n FROM orders GROUP BY ALL""",
)
def calendar_labels(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["id_date", "mois_libelle", "tri_mois", "trimestre", "semestre", "semaine", "saison", "jour_semaine", "weekend"]
    orders = _t(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    span = orders.agg(F.min("date"), F.max("date")).first()
    return orders.join(F.broadcast(layers.dim_date(spark, *span)), "date").groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


@_query(
    "bracket_join",
    "WITH x AS (SELECT p_size, p_retailprice FROM part) SELECT CASE WHEN p_size <= 10 THEN 'petit' WHEN p_size <= 30 THEN 'moyen' WHEN p_size <= 45 THEN 'grand' END AS classe, count(*) AS n, sum(p_size) AS total FROM x GROUP BY 1",
)
def bracket_join(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.createDataFrame([(0, 10, "petit"), (11, 30, "moyen"), (31, 45, "grand")], "lo int, hi int, classe string")
    return joins.bracket_join(_t(spark, sf, "part"), "p_size", table, "lo", "hi").groupBy("classe").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("total"))


@_query(
    "rollup_levels",
    f"WITH {_PLACE} SELECT region, departement, CAST(2 - grouping(region) - grouping(departement) AS INTEGER) AS level, count(*) AS n, sum(age) AS ages FROM r LEFT JOIN pl ON id = code GROUP BY ROLLUP (region, departement)",
)
def rollup_levels(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.enrich(records(spark, sf), places(spark, sf), "code_lieu_deces", "id_commune", ["region", "departement"], pad=5)
    return aggregates.rollup_levels(joined, ["region", "departement"], {"n": F.count(F.lit(1)), "ages": F.sum("age_au_deces")})


@_query("pivot_matrix", f"WITH {_R} SELECT annee AS annee_deces, {', '.join(f'nullif(count(*) FILTER (mois = {m}), 0) AS m{m}' for m in range(1, 13))} FROM r GROUP BY 1")
def pivot_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.pivot_matrix(records(spark, sf), "annee_deces", "mois_deces", F.count(F.lit(1)), list(range(1, 13)), "m")


@_query("match_coverage", f"WITH {_PLACE} SELECT count(*) AS n_rows, count(id) AS n_matched, count(*) - count(id) AS n_unmatched FROM g LEFT JOIN pl ON id = code AND pop > 5000")
def match_coverage(spark: SparkSession, sf: str) -> DataFrame:
    codes = records(spark, sf).select("code_lieu_deces").distinct()
    return joins.match_coverage(joins.enrich(codes, places(spark, sf).where("population_commune > 5000"), "code_lieu_deces", "id_commune", ["commune"], pad=5), "commune")


@_query("null_rates", f"WITH {_R}, n AS (SELECT count(*) AS n, count(sexe) AS s, count(age) AS a FROM r) SELECT unnest(['sexe', 'age_au_deces']) AS \"column\", unnest([round((n - s) * 100.0::DOUBLE / n, 2), round((n - a) * 100.0::DOUBLE / n, 2)]) AS null_pct FROM n")
def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.compute_null_rates(records(spark, sf), ["sexe", "age_au_deces"])


@_query(
    "quality_report",
    f"""WITH {_B}, k AS (SELECT count(*) AS n, count(*) FILTER (sexe IS NULL) AS a, count(*) FILTER (age NOT BETWEEN 5 AND 45) AS b_, count(*) FILTER (birth > d) AS c, count(*) FILTER (sexe IS NOT NULL AND age BETWEEN 5 AND 45 AND birth <= d) AS ok FROM b)
    SELECT unnest(['n_rows', 'score', 'invalid_sexe', 'invalid_age', 'invalid_dates', 'null_pct_sexe', 'null_pct_age_au_deces']) AS metric,
           unnest([CAST(n AS DOUBLE), round(ok * 100.0::DOUBLE / n, 2), CAST(a AS DOUBLE), CAST(b_ AS DOUBLE), CAST(c AS DOUBLE), round(a * 100.0::DOUBLE / n, 2), 0.0]) AS value FROM k""",
)
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    wanted = {"sexe": {"type": "not_null", "columns": ["sexe"]}, "age": {"type": "range", "column": "age_au_deces", "min": 5, "max": 45}, "dates": {"type": "date_coherence", "columns": ["date_naissance", "date_deces"]}, "autre": {"type": "unknown"}}
    return quality.compute_quality_report(born_records(spark, sf).select("sexe", "age_au_deces", "date_naissance", "date_deces"), wanted, max_columns=2)


@_query("quality_flags", f"WITH {_B} SELECT sexe IS NULL AS _has_null, age NOT BETWEEN 5 AND 45 AS _out_of_range, birth > d AS _date_incoherent, count(*) AS n FROM b GROUP BY ALL")
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.check_not_null(born_records(spark, sf), ["sexe", "none"])
    df = quality.check_date_coherence(quality.check_value_range(df, "age_au_deces", 5, 45), "date_naissance", "date_deces")
    return df.groupBy("_has_null", "_out_of_range", "_date_incoherent").agg(F.count(F.lit(1)).alias("n"))


@_query("reconciliation", f"WITH {_R} SELECT count(sexe) AS total_aggregate, count(*) AS total_source, count(*) - count(sexe) AS gap FROM r")
def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    r = records(spark, sf)
    return quality.reconciliation(r.where("sexe IS NOT NULL").groupBy("annee_deces").agg(F.count(F.lit(1)).alias("n")), "n", r)


@_query("reject_rates", f"WITH {_R} SELECT count(*) AS n_bronze, count(sexe) AS n_clean, round((count(*) - count(sexe)) * 100.0::DOUBLE / count(*), 2) AS pct_lost_clean FROM r")
def reject_rates(spark: SparkSession, sf: str) -> DataFrame:
    r = records(spark, sf)
    return quality.reject_rates({"bronze": r, "clean": r.where("sexe IS NOT NULL")})


@_query("decade_distribution", f"WITH {_R} SELECT (age // 10 * 10) || '-' || (age // 10 * 10 + 9) AS tranche, count(*) AS n FROM r GROUP BY 1")
def decade_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return quality.decade_distribution(records(spark, sf), "age_au_deces")


@_query("fill_report", f"WITH {_R} SELECT count(*) AS n_rows, count(*) FILTER (age > 30) AS n_vieux, round(count(sexe) * 100.0::DOUBLE / count(*), 2) AS pct_sexe FROM r")
def fill_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fill_report(records(spark, sf).withColumn("_vieux", F.col("age_au_deces") > 30), ["_vieux"], ["sexe"])


@_query(
    "table_metrics",
    """SELECT couche, table_name, cle, nb_lignes, nb_colonnes, nb_null_cle, round(nb_null_cle * 100.0::DOUBLE / nb_lignes, 2) AS pct_null_cle, 'ok' AS statut, CAST(NULL AS VARCHAR) AS notes FROM (
    SELECT 'bronze' AS couche, 'orders' AS table_name, 'o_orderkey' AS cle, count(*) AS nb_lignes, CAST(6 AS BIGINT) AS nb_colonnes, count(*) - count(o_orderkey) AS nb_null_cle FROM orders
    UNION ALL SELECT 'silver', 'customer', 'c_name', count(*), 5, count(*) - count(c_name) FROM customer)""",
)
def table_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = monitoring.metrics_of(spark, {"orders": ("bronze", f"{sf}/orders.parquet", "o_orderkey"), "customer": ("silver", f"{sf}/customer.parquet", "c_name")}, "run", "2024-01-01 00:00:00")
    return out.drop("run_id", "run_timestamp")


@_query("run_history", "SELECT 'run' || c_nationkey AS run_id, count(*) AS nb_tables, count(*) FILTER (c_acctbal >= 0) AS nb_ok, count(*) FILTER (c_acctbal < -500) AS nb_alertes FROM customer GROUP BY c_nationkey")
def run_history(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    rows_ = c.select(F.concat(F.lit("run"), "c_nationkey").alias("run_id"), F.col("c_nationkey").alias("run_timestamp"), F.when(F.col("c_acctbal") >= 0, "ok").otherwise("vide").alias("statut"), F.when(F.col("c_acctbal") < -500, "note").alias("notes"))
    return monitoring.run_history(rows_, 100).drop("run_timestamp")


@_query(
    "moving_averages",
    f"""WITH {_R}, g AS (SELECT annee, mois, annee * 12 + mois AS i, count(*) AS n FROM r GROUP BY 1, 2)
    SELECT i, n, round(avg(n) OVER (ORDER BY i RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), 1) AS moyenne_mobile_cal, round(avg(n) OVER (ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 1) AS moyenne_mobile, (SELECT n FROM g h WHERE h.i = g.i - 12) AS n_prior FROM g""",
)
def moving_averages(spark: SparkSession, sf: str) -> DataFrame:
    g = records(spark, sf).groupBy((F.col("annee_deces") * 12 + F.col("mois_deces")).alias("i")).agg(F.count(F.lit(1)).alias("n"))
    return windows.moving_average(windows.calendar_moving_average(joins.prior_period(g, [], "i", 12, "n"), "n", "i", few=True), "n", "i", 3, few=True)


@_query("rank_places", f"WITH {_PLACE} SELECT region, code AS code_lieu_deces, count(*) AS n, dense_rank() OVER (PARTITION BY region ORDER BY count(*) DESC) AS rang_region, dense_rank() OVER (ORDER BY count(*) DESC) AS rang FROM r LEFT JOIN pl ON id = code GROUP BY 1, 2")
def rank_places(spark: SparkSession, sf: str) -> DataFrame:
    counts = records(spark, sf).groupBy("code_lieu_deces").agg(F.count(F.lit(1)).alias("n"))
    each = joins.enrich(counts, places(spark, sf), "code_lieu_deces", "id_commune", ["region"], pad=5).select("region", "code_lieu_deces", "n")
    few = ranges.holds_at_most(each, ranges.RANGE_ROWS)
    return windows.rank_by(windows.rank_by(each, "n", ["region"], name="rang_region", few=few), "n", few=few)


@_query("control_limits", f"WITH {_R}, g AS (SELECT annee * 100 + mois AS k, count(*) AS n FROM r GROUP BY 1) SELECT CAST(k AS INTEGER) AS k, n, round(avg(n) OVER () - 2 * stddev_pop(n) OVER (), 2) AS limite_basse, round(avg(n) OVER () + 2 * stddev_pop(n) OVER (), 2) AS limite_haute FROM g")
def control_limits(spark: SparkSession, sf: str) -> DataFrame:
    return windows.control_limits(records(spark, sf).groupBy(dates.period_key("annee_deces", "mois_deces").alias("k")).agg(F.count(F.lit(1)).alias("n")), "n")


@_query(
    "place_zscore_severity",
    f"""WITH {_R}, g AS (SELECT code AS code_lieu_deces, count(*) AS nb_deces FROM r GROUP BY 1), z AS (SELECT *, round((nb_deces - avg(nb_deces) OVER ()) / stddev_pop(nb_deces) OVER (), 3) AS z_score FROM g)
    SELECT *, CASE WHEN abs(z_score) > 3 THEN 'CRITIQUE' WHEN abs(z_score) > 2.5 THEN 'ÉLEVÉ' WHEN abs(z_score) > 2 THEN 'MODÉRÉ' WHEN abs(z_score) > 1.5 THEN 'LÉGER' ELSE 'NORMAL' END AS niveau, CASE WHEN z_score > 0 THEN 'Surmortalité' ELSE 'Sous-mortalité' END AS sens FROM z""",
)
def place_zscore_severity(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("z_commune")({"fact": records(spark, sf)})


@_query(
    "survival_probability",
    f"""WITH {_B}, g AS (SELECT gen AS generation, age AS age_au_deces, count(*) AS nb_deces FROM b GROUP BY 1, 2), k AS (SELECT *, sum(nb_deces) OVER (PARTITION BY generation ORDER BY age_au_deces) AS c, sum(nb_deces) OVER (PARTITION BY generation) AS t FROM g)
    SELECT generation, age_au_deces, nb_deces, CAST(c AS BIGINT) AS cumul, round(CAST(c AS DOUBLE) / t, 4) AS part_cumul, round(1 - CAST(c AS DOUBLE) / t, 4) AS probabilite_survie, round(nb_deces * 100.0::DOUBLE / t, 4) AS mortalite_normalisee FROM k""",
)
def survival_probability(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("survie_generation")({"fact": measures.fact_model(born_records(spark, sf), GENERATIONS)})


@_query(
    "neighbour_mean",
    f"WITH {_B}, g AS (SELECT by_ AS annee_naissance, avg(age) AS m FROM b GROUP BY 1) SELECT annee_naissance, round((SELECT avg(m) FROM g h WHERE h.annee_naissance BETWEEN g.annee_naissance - 3 AND g.annee_naissance + 3 AND h.annee_naissance <> g.annee_naissance), 2) AS age_attendu FROM g",
)
def neighbour_mean(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("age_attendu")({"fact": measures.fact_model(born_records(spark, sf), GENERATIONS)})


@_query("generation_gap", f"WITH {_B}, g AS (SELECT gen AS generation, avg(age) AS m, min(by_) AS f FROM b GROUP BY 1) SELECT generation, round(m - lag(m) OVER (ORDER BY f), 2) AS ecart_generation FROM g")
def generation_gap(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("ecart_generation")({"fact": measures.fact_model(born_records(spark, sf), GENERATIONS)})


@_query("dominant_group", f"WITH {_B}, g AS (SELECT annee AS annee_deces, gen, count(*) AS n FROM b GROUP BY 1, 2) SELECT annee_deces, gen AS generation_dominante, n AS value FROM (SELECT *, row_number() OVER (PARTITION BY annee_deces ORDER BY n DESC, gen) AS rn FROM g) WHERE rn = 1")
def dominant_group(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("generation_dominante")({"fact": measures.fact_model(born_records(spark, sf), GENERATIONS)}, ["annee_deces"])


@_query("event_tags", f"WITH {_R} SELECT CAST(annee * 100 + mois AS INTEGER) AS \"AnMois\", CASE WHEN annee = 1998 AND mois IN (3, 4) THEN 'onde' WHEN annee = 1999 AND mois = 12 THEN 'tempete' END AS evenement FROM r GROUP BY annee, mois")
def event_tags(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("evenement")({"by_month": gold.by_month(records(spark, sf), LIMITS)}, events=((1998, (3, 4), "onde"), (1999, (12,), "tempete")))


@_query("top_k_places", f"WITH {_R} SELECT code AS code_lieu_deces, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, code_lieu_deces LIMIT 15")
def top_k_places(spark: SparkSession, sf: str) -> DataFrame:
    return rows.top_k(records(spark, sf).groupBy("code_lieu_deces").agg(F.count(F.lit(1)).alias("n")), ["n"], 15, ["code_lieu_deces"])


@_query("pyramid", f"WITH {_R} SELECT (age // 5 * 5) || '-' || (age // 5 * 5 + 4) || ' ans' AS tranche, count(*) FILTER (sexe = 'F') AS femmes, -count(*) FILTER (sexe = 'M') AS hommes FROM r GROUP BY 1")
def pyramid(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("pyramide")({"fact": records(spark, sf)})


_SHARES = "round(count(*) FILTER (sexe = 'F') * 1.0::DOUBLE / count(*), 4) AS pct_femmes, round(count(*) FILTER (age <= 17) * 1.0::DOUBLE / count(*), 4) AS part_mineurs, round(avg(age), 2) AS age_moyen, median(age) AS age_median, round(avg(age) FILTER (sexe = 'F') - avg(age) FILTER (sexe = 'M'), 2) AS ecart_longevite, count(*) AS total_deces, count(DISTINCT code) AS communes_distinctes"


@_query("measures_by_year", f"WITH {_R} SELECT annee AS annee_deces, {_SHARES} FROM r GROUP BY 1")
def measures_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"fact": records(spark, sf)}, ["pct_femmes", "part_mineurs", "age_moyen", "age_median", "ecart_longevite", "total_deces", "communes_distinctes"], ["annee_deces"])


@_query("measure_yoy", f"WITH {_R}, y AS (SELECT max(annee) AS y FROM r), k AS (SELECT sexe, count(*) FILTER (annee = y) AS a, count(*) FILTER (annee = y - 1) AS b FROM r, y GROUP BY 1) SELECT sexe, a AS variation_annuelle_n, b AS variation_annuelle_n_1, round(CAST(a - b AS DOUBLE) * 100 / nullif(b, 0), 2) AS variation_annuelle_pct FROM k")
def measure_yoy(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("variation_annuelle")({"fact": records(spark, sf)}, ["sexe"])


@_query("measure_against_all", f"WITH {_B} SELECT gen AS generation, round(avg(age) - (SELECT avg(age) FROM b), 2) AS ecart_age_national FROM b GROUP BY 1")
def measure_against_all(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("ecart_age_national")({"fact": measures.fact_model(born_records(spark, sf), GENERATIONS)}, ["generation"])


@_query(
    "measure_baseline",
    f"WITH {_R}, g AS (SELECT annee, mois, annee * 100 + mois AS k, count(*) AS n FROM r GROUP BY 1, 2), h AS (SELECT *, round(avg(n) OVER (PARTITION BY mois ORDER BY annee RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING), 2) AS b FROM g) SELECT CAST(k AS INTEGER) AS \"AnMois\", b AS baseline, round((n - b) * 100 / b, 2) AS surmortalite_pct, coalesce(round((n - b) * 100 / b, 2) > 5, false) AS est_evenement FROM h",
)
def measure_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("baseline")({"by_month": gold.by_month(records(spark, sf), LIMITS)})


@_query("winter_excess", f"WITH {_R} SELECT annee AS annee_deces, round(CAST(count(*) FILTER (mois IN (11, 12, 1, 2)) - count(*) FILTER (mois BETWEEN 6 AND 9) AS DOUBLE) * 100 / nullif(count(*) FILTER (mois BETWEEN 6 AND 9), 0), 2) AS surmortalite_hivernale FROM r GROUP BY 1")
def winter_excess(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("surmortalite_hivernale")({"fact": records(spark, sf)}, ["annee_deces"])


@_query("group_statistics", f"WITH {_R}, g AS (SELECT sexe, annee, mois, count(*) AS n, avg(age) AS a FROM r GROUP BY 1, 2, 3) SELECT sexe, max(n) AS max_total, round(avg(a), 6) AS mean FROM g GROUP BY 1")
def group_statistics(spark: SparkSession, sf: str) -> DataFrame:
    r, inner = records(spark, sf), ["annee_deces", "mois_deces"]
    means = aggregates.mean_of_means(r, ["sexe"], inner, "age_au_deces").withColumn("mean", F.round("mean", 6))
    most = aggregates.max_of_totals(r, ["sexe"], inner)
    return most.join(means.withColumnRenamed("sexe", "s"), F.col("sexe").eqNullSafe(F.col("s"))).drop("s")


_LONG = ("nb_deces", "count(*)::DOUBLE"), ("age_moyen", "avg(age)"), ("pct_femmes", "count(*) FILTER (sexe = 'F') / count(*)"), ("pct_hommes", "count(*) FILTER (sexe = 'M') / count(*)"), ("part_mineurs", "count(*) FILTER (age <= 17) / count(*)"), ("part_85", "count(*) FILTER (age >= 85) / count(*)")


@_query(
    "kpi_comparison",
    f"WITH {_R}, " + ", ".join(f"k{i} AS (SELECT code, '{n}' AS indicateur, {e} AS v, (SELECT {e} FROM r) AS a FROM r GROUP BY code)" for i, (n, e) in enumerate(_LONG)) + ", u AS (" + " UNION ALL ".join(f"SELECT * FROM k{i}" for i in range(6)) + ") SELECT code AS code_lieu_deces, indicateur, round(v, 4) AS valeur, round(a, 4) AS \"national\", round(v - a, 4) AS ecart, dense_rank() OVER (PARTITION BY indicateur ORDER BY round(v, 4) DESC) AS rang FROM u",
)
def kpi_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("comparaison_commune")({"fact": records(spark, sf)})


@_query(
    "measures_of_months",
    f"""WITH {_MONTHLY} SELECT annee, CAST(sum(nb_deces) AS BIGINT) AS deces_mensuel, CAST(sum(variation_vs_n_1) AS BIGINT) AS variation_absolue, round(avg(indice_saisonnalite), 3) AS saisonnalite_moyenne,
    max(indice_saisonnalite) AS saisonnalite_max, max(z_score) AS z_max, count(*) FILTER (anomalie_flag) AS mois_anomalie, CAST(sum(nb_deces) FILTER (abs(z_score) > 2) AS BIGINT) AS deces_seuil_z FROM monthly GROUP BY annee""",
)
def measures_of_months(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"by_month": gold.by_month(records(spark, sf), LIMITS)}, ("deces_mensuel", "variation_absolue", "saisonnalite_moyenne", "saisonnalite_max", "z_max", "mois_anomalie", "deces_seuil_z"), ["annee"])


@_query(
    "measures_of_places",
    f"""WITH {_PLACE} SELECT round(avg(taux_mortalite), 4) AS taux_mortalite_moyen, round(avg(densite_deces), 4) AS densite_moyenne, round(avg(indice_vieillissement), 2) AS vieillissement_moyen, round(sum(nb_deces) * 1000 / sum(population_commune), 4) AS taux_pour_mille,
    count(DISTINCT id_commune) FILTER (anomalie_mortalite) AS communes_anomalie, round(count(*) FILTER (anomalie_mortalite) / count(*), 4) AS pct_communes_anomalie FROM place""",
)
def measures_of_places(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"by_place": place_metrics(spark, sf)}, ("taux_mortalite_moyen", "densite_moyenne", "vieillissement_moyen", "taux_pour_mille", "communes_anomalie", "pct_communes_anomalie"), [])


@_query("expected_deaths", f"WITH {_PLACE}, t AS (SELECT sum(nb_deces) / sum(population_commune) AS r FROM place) SELECT id_commune, round(r * population_commune, 2) AS deces_attendus FROM place, t")
def expected_deaths(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("deces_attendus")({"by_place": place_metrics(spark, sf)})


@_query(
    "measures_of_cohorts",
    ORACLE["cohort_metrics"].replace("SELECT id_date, id_date ||", ", co AS (SELECT id_date, id_date ||", 1) + """) SELECT annee_naissance, CAST(sum(nb_centenaires) AS BIGINT) AS centenaires_generation, max(age_max) AS longevite_max, round(avg(age_moyen_deces), 2) AS longevite_moyenne, round(avg(indice_vieillissement), 2) AS vieillissement_generation,
    max(annee_deces_max) - min(annee_deces_min) AS periode_active, CASE WHEN max(tendance_mortalite) >= 100 THEN '↑' WHEN max(tendance_mortalite) <= 0 THEN '↓' ELSE '→' END AS tendance, count(*) FILTER (anomalie_generation) AS anomalies_generation FROM co GROUP BY 1""",
)
def measures_of_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"by_cohort": cohort_metrics(spark, sf)}, ("centenaires_generation", "longevite_max", "longevite_moyenne", "vieillissement_generation", "periode_active", "tendance", "anomalies_generation"), ["annee_naissance"])


@_query(
    "measures_by_sex_share",
    f"""WITH {_R} SELECT annee AS annee_deces, count(*) FILTER (sexe = 'M') AS total_hommes, count(*) FILTER (sexe = 'F') AS total_femmes, round(count(*) FILTER (sexe = 'M') / count(*), 4) AS pct_hommes, round(count(*) FILTER (sexe = 'M') / nullif(count(*) FILTER (sexe = 'F'), 0), 4) AS ratio_h_f,
    round(avg(age) FILTER (sexe = 'F'), 2) AS age_moyen_femmes, round(avg(age) FILTER (sexe = 'M'), 2) AS age_moyen_hommes, count(*) FILTER (age BETWEEN 5 AND 14) AS nb_5_14, count(*) FILTER (age BETWEEN 15 AND 17) AS nb_15_17, count(*) FILTER (age BETWEEN 1 AND 4) AS nb_1_4,
    round(count(*) FILTER (age <= 17 AND sexe = 'M') / nullif(count(*) FILTER (age <= 17), 0), 4) AS pct_garcons_mineurs FROM r GROUP BY 1""",
)
def measures_by_sex_share(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"fact": records(spark, sf)}, ("total_hommes", "total_femmes", "pct_hommes", "ratio_h_f", "age_moyen_femmes", "age_moyen_hommes", "nb_5_14", "nb_15_17", "nb_1_4", "pct_garcons_mineurs"), ["annee_deces"])


@_query("measure_excess_of_year", f"WITH {_R} SELECT sexe, round((count(*) FILTER (annee = 1999) - count(*) FILTER (annee BETWEEN 1996 AND 1998) / 3) * 100 / nullif(count(*) FILTER (annee BETWEEN 1996 AND 1998) / 3, 0), 2) AS surmortalite_annee FROM r GROUP BY 1")
def measure_excess_of_year(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("surmortalite_annee")({"fact": records(spark, sf)}, ["sexe"], year=1999, years=3)


@_query("measure_window_change", f"WITH {_R}, k AS (SELECT sexe, count(*) FILTER (annee BETWEEN 1998 AND 1999) AS now, count(*) FILTER (annee BETWEEN 1996 AND 1997) AS before FROM r WHERE age >= 40 GROUP BY 1) SELECT *, round((now - before) * 100 / nullif(before, 0), 2) AS evolution_fenetre FROM k")
def measure_window_change(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("evolution_fenetre")({"fact": records(spark, sf)}, ["sexe"], first=1998, last=1999, least=40)


@_query("measure_age_change", f"WITH {_R}, k AS (SELECT annee AS annee_deces, avg(age) AS m FROM r WHERE age >= 20 GROUP BY 1) SELECT annee_deces, round(m - (SELECT m FROM k ORDER BY annee_deces LIMIT 1), 2) AS evolution_age FROM k")
def measure_age_change(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("evolution_age")({"fact": records(spark, sf)}, least=20)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


from cairn.plans import layer_queries, measure_queries, scale_queries, state_queries  # noqa: E402, F401  they add their queries
