"""Queries of the measures that need other ages than the shipped lines have, and of reports over them.

The age is 2.3 times the quantity here, so that minors and the very old occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import rules
from cairn.operators import aggregates, joins, rows
from cairn.plans import gold, layers, measures
from cairn.plans import queries as core
from cairn.plans.queries import _query

_O = core._B.replace("CAST(l_quantity AS INTEGER) AS age", "CAST(l_quantity AS INTEGER) * 23 // 10 AS age")
_OM = core._MONTHLY.replace("CAST(l_quantity AS INTEGER) AS age", "CAST(l_quantity AS INTEGER) * 23 // 10 AS age")


def old_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose ages reach from 2 to 115."""
    return core.born_records(spark, sf).withColumn("age_au_deces", F.floor(F.col("age_au_deces") * 23 / 10).cast("int"))


def _fact(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"fact": measures.fact_model(old_records(spark, sf), core.GENERATIONS)}


def _n(cond: str) -> str:
    return f"count(*) FILTER ({cond})"


def _p(part: str, whole: str, digits: int = 4) -> str:
    return f"round({part} * 1.0::DOUBLE / nullif({whole}, 0), {digits})"


_YEARLY = {
    "nb_centenaires": _n("age >= 100"), "nb_supercentenaires": _n("age >= 110"), "nb_100_104": _n("age BETWEEN 100 AND 104"), "nb_105_109": _n("age BETWEEN 105 AND 109"), "nb_mineurs": _n("age <= 17"), "nb_0_1": _n("age <= 1"),
    "pct_centenaires": _p(_n("age >= 100"), "count(*)"), "pct_100_104": _p(_n("age BETWEEN 100 AND 104"), _n("age >= 100")), "pct_femmes_centenaires": _p(_n("age >= 100 AND sexe = 'F'"), _n("age >= 100")),
    "pct_hommes_centenaires": _p(_n("age >= 100 AND sexe = 'M'"), _n("age >= 100")), "pct_nourrissons_mineurs": _p(_n("age <= 1"), _n("age <= 17")), "age_moyen_centenaires": "round(avg(age) FILTER (age >= 100), 2)", "part_85": _p(_n("age >= 85"), "count(*)"),
    "deces_par_an": "round(count(*) / count(DISTINCT annee), 2)", "age_moyen_generation": "round(avg(age), 2)", "age_moyen_generation_litteral": "round(avg(annee), 2)",
    "esperance_residuelle": "round((SELECT avg(age) FROM b) - avg(age), 2)", "ecart_85_national": f"round({_n('age >= 85')} / count(*) - (SELECT {_n('age >= 85')} / count(*) FROM b), 4)",
    "anomalie_ratio_f_h": f"round({_n(chr(115) + 'exe = ' + repr('F'))} / {_n('sexe = ' + repr('M'))} - (SELECT {_n('sexe = ' + repr('F'))} / {_n('sexe = ' + repr('M'))} FROM b), 4)",
}


@_query("measures_of_generations", f"WITH {_O} SELECT gen AS generation, {', '.join(f'{e} AS {n}' for n, e in _YEARLY.items())} FROM b GROUP BY 1")
def measures_of_generations(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together(_fact(spark, sf), list(_YEARLY), ["generation"])


@_query("measure_means_of_years", f"WITH {_O}, y AS (SELECT annee, round(avg(age), 2) AS m FROM b GROUP BY 1) SELECT DISTINCT b.annee AS annee_deces, mois AS mois_deces, m AS age_moyen_mensuel FROM b JOIN y USING (annee)")
def measure_means_of_years(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("age_moyen_mensuel")(_fact(spark, sf), ["mois_deces"])


@_query("measure_mean_of_generations", f"WITH {_O}, g AS (SELECT annee, gen, avg(age) AS m FROM b GROUP BY 1, 2) SELECT annee AS annee_deces, round(avg(m), 2) AS age_moyen_par_generation FROM g GROUP BY 1")
def measure_mean_of_generations(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("age_moyen_par_generation")(_fact(spark, sf), ["annee_deces"])


@_query("measure_months_of_years", f"WITH {_O}, g AS (SELECT annee, mois, count(*) AS n FROM b GROUP BY 1, 2) SELECT annee AS annee_deces, round(avg(n), 2) AS deces_moyen_par_mois, max(n) AS mois_max FROM g GROUP BY 1")
def measure_months_of_years(spark: SparkSession, sf: str) -> DataFrame:
    model = _fact(spark, sf)
    return measures.measure("deces_moyen_par_mois")(model, ["annee_deces"]).join(measures.measure("mois_max")(model, ["annee_deces"]), "annee_deces")


def _change(name: str, cond: str) -> str:
    return f"""WITH {_O}, h AS (SELECT * FROM b WHERE {cond}), k AS (SELECT gen, count(*) FILTER (annee = y) AS a, count(*) FILTER (annee = y - 1) AS p FROM h, (SELECT max(annee) AS y FROM h) GROUP BY 1)
    SELECT gen AS generation, a AS {name}_n, p AS {name}_n_1, round(CAST(a - p AS DOUBLE) * 100 / nullif(p, 0), 2) AS {name}_pct FROM k"""


@_query("measure_change_of_the_old", _change("evolution_centenaires", "age >= 100"))
def measure_change_of_the_old(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("evolution_centenaires")(_fact(spark, sf), ["generation"])


@_query("measure_change_of_minors", _change("tendance_mineurs", "age < 18"))
def measure_change_of_minors(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("tendance_mineurs")(_fact(spark, sf), ["generation"])


@_query("measure_excess_of_month", f"WITH {_O} SELECT gen AS generation, round(({_n('annee = 1999 AND mois = 4')} - {_n('annee BETWEEN 1996 AND 1998 AND mois = 4')} / 3) * 100 / nullif({_n('annee BETWEEN 1996 AND 1998 AND mois = 4')} / 3, 0), 2) AS surmortalite_annee FROM b GROUP BY 1")
def measure_excess_of_month(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("surmortalite_annee")(_fact(spark, sf), ["generation"], year=1999, years=3, month=4)


@_query(
    "measure_cohort_scores",
    f"""WITH {_O}, g AS (SELECT by_ AS annee_naissance, count(*) AS nb_deces FROM b GROUP BY 1), z AS (SELECT *, round((nb_deces - avg(nb_deces) OVER ()) / stddev_pop(nb_deces) OVER (), 3) AS z_score FROM g)
    SELECT *, CASE WHEN abs(z_score) > 3 THEN 'CRITIQUE' WHEN abs(z_score) > 2.5 THEN 'ÉLEVÉ' WHEN abs(z_score) > 2 THEN 'MODÉRÉ' WHEN abs(z_score) > 1.5 THEN 'LÉGER' ELSE 'NORMAL' END AS niveau, CASE WHEN z_score > 0 THEN 'Surmortalité' ELSE 'Sous-mortalité' END AS sens FROM z""",
)
def measure_cohort_scores(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("z_cohorte")(_fact(spark, sf))


@_query("measure_place_ranks", f"WITH {_O} SELECT code AS code_lieu_deces, count(*) AS nb_deces, CAST(dense_rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rang_commune FROM b GROUP BY 1")
def measure_place_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("rang_commune")(_fact(spark, sf))


def _monthly(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"by_month": gold.by_month(core.records(spark, sf), core.LIMITS)}


@_query("measure_month_changes", f"WITH {core._MONTHLY} SELECT round(avg(variation_pct), 2) AS variation_moyenne_pct, CAST(sum(nb_deces) AS BIGINT) AS deces_periode FROM monthly")
def measure_month_changes(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together(_monthly(spark, sf), ["variation_moyenne_pct", "deces_periode"])


@_query("measure_calendar_average", f"WITH {core._MONTHLY} SELECT \"AnMois\", round(avg(nb_deces) OVER (ORDER BY annee * 12 + mois RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), 1) AS moyenne_mobile_12m_cal FROM monthly")
def measure_calendar_average(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("moyenne_mobile_12m_cal")(_monthly(spark, sf))


@_query("measure_seasonal_profile", f"WITH {core._MONTHLY}, profile AS (SELECT mois, annee, avg(indice_saisonnalite) AS i FROM monthly GROUP BY 1, 2) SELECT mois, round(avg(i), 3) AS profil_saisonnier FROM profile GROUP BY 1")
def measure_seasonal_profile(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("profil_saisonnier")(_monthly(spark, sf))


@_query("measure_control_limits", f"WITH {core._MONTHLY} SELECT \"AnMois\", nb_deces, round(avg(nb_deces) OVER () - 2 * stddev_pop(nb_deces) OVER (), 2) AS limite_basse, round(avg(nb_deces) OVER () + 2 * stddev_pop(nb_deces) OVER (), 2) AS limite_haute FROM monthly")
def measure_control_limits(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("limites_controle")(_monthly(spark, sf))


_COHORTS = core.ORACLE["cohort_metrics"].replace("SELECT id_date, id_date ||", ", co AS (SELECT id_date, id_date ||", 1) + ")"


@_query(
    "measure_cohort_means",
    _COHORTS + " SELECT annee_naissance, round(avg(age_moyen_deces) FILTER (nb_femmes > nb_hommes), 2) AS age_moyen_femmes_agg, round(avg(age_moyen_deces) FILTER (nb_hommes > nb_femmes), 2) AS age_moyen_hommes_agg, round(avg(surmortalite), 3) AS surmortalite_moyenne FROM co GROUP BY 1",
)
def measure_cohort_means(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"by_cohort": core.cohort_metrics(spark, sf)}, ["age_moyen_femmes_agg", "age_moyen_hommes_agg", "surmortalite_moyenne"], ["annee_naissance"])


_AGES = core.ORACLE["age_month_metrics"].replace("SELECT age, id_date, age || '|' || id_date", ", ag AS (SELECT age, id_date, age || '|' || id_date", 1) + ")"


@_query("measures_of_ages", _AGES + " SELECT id_date, round(avg(indice_survie), 4) AS survie_moyenne, count(*) FILTER (anomalie_distribution) AS anomalies_distribution FROM ag GROUP BY 1")
def measures_of_ages(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"by_age": core.age_month_metrics(spark, sf)}, ["survie_moyenne", "anomalies_distribution"], ["id_date"])


@_query("measure_population", f"WITH {core._PLACE} SELECT round(sum(population_commune), 2) AS population_couverte FROM place")
def measure_population(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("population_couverte")({"by_place": core.place_metrics(spark, sf)}).select(F.round("population_couverte", 2).alias("population_couverte"))


@_query(
    "measure_all_anomalies",
    _COHORTS + f", a1 AS (SELECT count(*) FILTER (anomalie_generation) AS x FROM co), a2 AS ({_AGES} SELECT count(*) FILTER (anomalie_distribution) AS y FROM ag), a3 AS (WITH {core._PLACE} SELECT count(DISTINCT id_commune) FILTER (anomalie_mortalite) AS z FROM place) SELECT x + y + z AS total_anomalies FROM a1, a2, a3",
)
def measure_all_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("total_anomalies")({"by_cohort": core.cohort_metrics(spark, sf), "by_age": core.age_month_metrics(spark, sf), "by_place": core.place_metrics(spark, sf)})


@_query("measure_period_of_calendar", f"WITH {core._MONTHLY}, c AS (SELECT DISTINCT year(o_orderdate) * 100 + month(o_orderdate) AS k, CAST(quarter(o_orderdate) AS INTEGER) AS q FROM orders) SELECT q AS trimestre, CAST(sum(nb_deces) AS BIGINT) AS deces_periode FROM monthly JOIN c ON k = \"AnMois\" GROUP BY 1")
def measure_period_of_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Deaths of the months that a daily calendar has, by its quarters; the calendar is reduced to months first."""
    days = core._t(spark, sf, "orders").select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("AnMois")).withColumn("trimestre", F.ceil(F.pmod("AnMois", F.lit(100)) / 3).cast("int"))
    months = joins.month_relation(days, "AnMois").withColumn("trimestre", F.ceil(F.pmod("AnMois", F.lit(100)) / 3).cast("int"))
    return measures.measure("deces_periode")({"by_month": joins.link(_monthly(spark, sf)["by_month"], months, "AnMois", "AnMois")}, ["trimestre"])


@_query(
    "measure_places_off_limits",
    f"WITH {_O}, g AS (SELECT code, count(*) AS n FROM b GROUP BY 1), z AS (SELECT round((n - avg(n) OVER ()) / stddev_pop(n) OVER (), 3) AS z FROM g) SELECT count(*) FILTER (abs(z) > 2.5) AS communes_z FROM z",
)
def measure_places_off_limits(spark: SparkSession, sf: str) -> DataFrame:
    return measures.measure("communes_z")(_fact(spark, sf))


@_query("measure_cohort_gap", _COHORTS + " SELECT annee_naissance, round(avg(age_moyen_deces) FILTER (nb_femmes > nb_hommes) - avg(age_moyen_deces) FILTER (nb_hommes > nb_femmes), 2) AS ecart_longevite_agg FROM co GROUP BY 1")
def measure_cohort_gap(spark: SparkSession, sf: str) -> DataFrame:
    return measures.together({"by_cohort": core.cohort_metrics(spark, sf)}, ["ecart_longevite_agg"], ["annee_naissance"])


@_query(
    "measures_one_scan",
    f"""WITH {_O}, a AS (SELECT avg(age) AS m, {_n('age >= 85')} / count(*) AS p FROM b)
    SELECT 'generation' AS contexte, gen AS groupe, round(any_value(m) - avg(age), 2) AS esperance_residuelle, round({_n('age >= 85')} / count(*) - any_value(p), 4) AS ecart_85_national, round({_n('age >= 85')} / count(*), 4) AS part_85, count(*) AS total_deces FROM b, a GROUP BY gen
    UNION ALL SELECT 'lieu', code, round(any_value(m) - avg(age), 2), round({_n('age >= 85')} / count(*) - any_value(p), 4), round({_n('age >= 85')} / count(*), 4), count(*) FROM b, a GROUP BY code
    UNION ALL SELECT 'tout', NULL, 0.0, 0.0, round({_n('age >= 85')} / count(*), 4), count(*) FROM b, a
    UNION ALL SELECT 'femmes', gen, round((SELECT avg(age) FROM b WHERE sexe = 'F') - avg(age), 2), round({_n('age >= 85')} / count(*) - (SELECT {_n('age >= 85')} / count(*) FROM b WHERE sexe = 'F'), 4), round({_n('age >= 85')} / count(*), 4), count(*) FROM b WHERE sexe = 'F' GROUP BY gen""",
)
def measures_one_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Measures by generation, by place, of all, and of women by generation, two of them against all, from one pass over the records."""
    names = ["esperance_residuelle", "ecart_85_national", "part_85", "total_deces"]
    found = measures.evaluate(_fact(spark, sf), {"generation": (names, ["generation"]), "lieu": (names, ["code_lieu_deces"]), "tout": (names, []), "femmes": (names, ["generation"], "sexe = 'F'")})
    key = {"generation": F.col("generation"), "femmes": F.col("generation"), "lieu": F.col("code_lieu_deces"), "tout": F.lit(None).cast("string")}
    return rows.union_all([df.select(F.lit(c).alias("contexte"), key[c].alias("groupe"), *names) for c, df in found.items()])


# reports
@_query(
    "report_decades",
    f"WITH {_O}, g AS (SELECT age // 10 * 10 AS d, count(*) AS n, count(*) FILTER (sexe = 'M') AS h, count(*) FILTER (sexe = 'F') AS f FROM b GROUP BY 1) SELECT CASE WHEN d >= 100 THEN '100 ans et +' ELSE d || '-' || (d + 9) || ' ans' END AS tranche, CAST(sum(n) AS BIGINT) AS nb_deces, CAST(sum(h) AS BIGINT) AS nb_hommes, CAST(sum(f) AS BIGINT) AS nb_femmes, round(sum(h) / nullif(sum(f), 0), 4) AS ratio_h_f, round(sum(n) * 100 / (SELECT count(*) FROM b), 2) AS share FROM g GROUP BY 1",
)
def report_decades(spark: SparkSession, sf: str) -> DataFrame:
    """Ages by decade with sexes, their ratio and the share of all."""
    band = joins.enrich(old_records(spark, sf), layers.dim_age(spark), "age_au_deces", "age", ["tranche_age_10_ans"])
    each = measures.together({"fact": band.withColumnRenamed("tranche_age_10_ans", "tranche")}, ["total_deces", "total_hommes", "total_femmes", "ratio_h_f"], ["tranche"])
    named = rows.rename(each, {"total_deces": "nb_deces", "total_hommes": "nb_hommes", "total_femmes": "nb_femmes"})
    return aggregates.with_totals(named, {"__t": F.sum("nb_deces")}).withColumn("share", F.round(F.col("nb_deces") * 100.0 / F.col("__t"), 2)).drop("__t")


@_query("report_old_by_department", f"WITH {core._PLACE.replace(core._R, _O)} SELECT departement, count(*) AS nb_centenaires FROM b JOIN pl ON id = code WHERE b.age >= 100 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def report_old_by_department(spark: SparkSession, sf: str) -> DataFrame:
    """The ten departments with the most centenarians."""
    placed = joins.enrich(old_records(spark, sf), core.places(spark, sf), "code_lieu_deces", "id_commune", ["departement"], pad=5)
    return rows.top_k(measures.measure("nb_centenaires")({"fact": placed.where("age_au_deces >= 100 AND departement IS NOT NULL")}, ["departement"]), ["nb_centenaires"], 10, ["departement"])


@_query("report_place_profile", f"WITH {_O}, k AS (SELECT code, age // 5 * 5 AS d, count(*) AS n FROM b GROUP BY 1, 2) SELECT code AS code_lieu_deces, CASE WHEN d >= 100 THEN '100 ans et +' ELSE d || '-' || (d + 4) || ' ans' END AS tranche, CAST(sum(n) AS BIGINT) AS nb_deces, round(sum(n) * 100 / sum(sum(n)) OVER (PARTITION BY code), 2) AS share FROM k GROUP BY 1, 2")
def report_place_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Each place's ages by bands of five years and their share."""
    band = rules.rules_case("age_au_deces", rules.AGE_BANDS["tranche_age_5_ans"]).alias("tranche")
    each = old_records(spark, sf).groupBy("code_lieu_deces", band).agg(F.count(F.lit(1)).alias("nb_deces"))
    return aggregates.share(each, ["code_lieu_deces"], "nb_deces", 2)


@_query(
    "report_regions",
    f"WITH {core._PLACE} SELECT region, CAST(sum(nb_deces) AS BIGINT) AS nb_deces, round(sum(nb_deces) * 1000.0::DOUBLE / sum(population_commune), 4) AS taux_pour_mille, median(indice_vieillissement) AS vieillissement_median FROM place JOIN pl ON id = id_commune WHERE population_commune > 0 GROUP BY region",
)
def report_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Volume, mortality and median ageing index of each region's places with a known population."""
    places = core.places(spark, sf)
    marts = gold.mart_place(gold.by_place(core.records(spark, sf), places, core.LIMITS), places).where("population_commune > 0")
    rates = measures.together({"by_place": marts}, ["taux_pour_mille"], ["region"])
    volume = aggregates.grouped(marts, ["region"], {"nb_deces": F.sum("nb_deces"), "vieillissement_median": F.median("indice_vieillissement")})
    return volume.join(rates, "region").select("region", "nb_deces", "taux_pour_mille", "vieillissement_median")


@_query(
    "report_excess_by_generation",
    f"""WITH {_O}, g AS (SELECT gen AS generation, count(*) AS nb_deces FROM b GROUP BY 1), z AS (SELECT *, round((nb_deces - avg(nb_deces) OVER ()) / stddev_pop(nb_deces) OVER (), 3) AS z_score FROM g)
    SELECT *, CASE WHEN abs(z_score) > 3 THEN 'CRITIQUE' WHEN abs(z_score) > 2.5 THEN 'ÉLEVÉ' WHEN abs(z_score) > 2 THEN 'MODÉRÉ' WHEN abs(z_score) > 1.5 THEN 'LÉGER' ELSE 'NORMAL' END AS niveau, CASE WHEN z_score > 0 THEN 'Surmortalité' ELSE 'Sous-mortalité' END AS sens FROM z""",
)
def report_excess_by_generation(spark: SparkSession, sf: str) -> DataFrame:
    """Each generation's volume against the others, with its class."""
    return measures.measure("z_generation")(_fact(spark, sf))
