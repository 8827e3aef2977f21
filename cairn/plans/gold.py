"""Fact table, aggregates and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions import dates, numbers, text
from cairn.operators import aggregates, joins, rows, windows


@dataclass(frozen=True)
class Limits:
    """Ages that count as very old, minor and senior, and thresholds of the anomaly flags."""

    centenarian: int = 100
    minor: int = 18
    senior: int = 65
    monthly_z: float = 2.0
    z: float = 2.5
    least_population: float = 50.0
    first_birth: int = 1850
    last_birth: int = 2025


def _flags(limits: Limits, senior: bool = False) -> dict[str, Column]:
    age, sex = F.col("age_au_deces"), F.col("sexe")
    out = {"nb_hommes": sex == "M", "nb_femmes": sex == "F", "nb_centenaires": age >= limits.centenarian, "nb_mineurs": age < limits.minor}
    return out | ({"_nb_seniors": age >= limits.senior} if senior else {})


def _sex_shares(df: DataFrame) -> DataFrame:
    """Shares among records of known sex."""
    known = F.col("nb_hommes") + F.col("nb_femmes")
    return df.withColumns({"pct_hommes": numbers.ratio("nb_hommes", known, 100, 2), "pct_femmes": numbers.ratio("nb_femmes", known, 100, 2)})


def profile_of_states(states: DataFrame, by: Sequence[str], limits: Limits = Limits(), ages: Mapping[str, str] | None = None, senior: bool = False, more: Mapping[str, Column] | None = None) -> DataFrame:
    """The counts of ``aggregates.profile`` from rows that stand for ``n`` records each, with statistics of their age."""
    n, age = F.col("n"), F.col("age_au_deces")
    count = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0).cast("long"))
    stats = {"avg": lambda: F.round(F.sum(age * n) / F.sum(F.when(age.isNotNull(), n)), 1), "median": lambda: F.percentile(age, 0.5, n), "min": lambda: F.min(age), "max": lambda: F.max(age)}
    aggs = {"nb_deces": F.sum(n), **{c: stats[s]() for c, s in (ages or {}).items()}, **{c: count(p) for c, p in _flags(limits, senior).items()}, **(more or {})}
    return aggregates.grouped(states, by, aggs)


def with_keys(records: DataFrame) -> DataFrame:
    """The fact table: records with the keys of the four aggregates."""
    death = dates.period_key("annee_deces", "mois_deces")
    birth = dates.period_key(F.year("date_naissance"), F.month("date_naissance"))
    code = text.zfill("code_lieu_deces")
    return records.withColumns(
        {
            "key_aggAge": rows.composite_key(["age_au_deces", death]),
            "key_aggTemporel": death.cast("string"),
            "key_aggGeographie": code,
            "key_aggGeneration": rows.composite_key([birth, "age_au_deces", code]),
        }
    )


def by_age(records: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per age and month."""
    known = rows.require(records, ["age_au_deces", "annee_deces", "mois_deces"])
    keyed = known.withColumns({"age": F.col("age_au_deces"), "id_date": dates.period_key("annee_deces", "mois_deces")})
    return finish_age(aggregates.profile(keyed, ["age", "id_date"], flags=_flags(limits), stats={"nb_deces": "count"}), limits)


def finish_age(agg: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Shares, weighted ages, survival and flags of counts by age and month."""
    agg = _sex_shares(agg).withColumns({"key_age": rows.composite_key(["age", "id_date"]), "ratio_h_f": numbers.ratio("nb_hommes", "nb_femmes", 1, 3)})
    agg = windows.share_of_total(agg, "nb_deces", digits=4)
    agg = windows.weighted_mean_over(agg, "age", "nb_deces", ["id_date"], name="age_moyen")
    agg = windows.weighted_median(agg, "age", "nb_deces", ["id_date"], name="age_median")
    agg = windows.survival_index(agg, "nb_deces", ["id_date"], ["age"])
    agg = windows.zscore_flag(agg, "nb_deces", ["id_date"], limits.z, flag_col="anomalie_distribution")
    return agg.select(
        "age", "id_date", "key_age", "nb_deces", "pct_total", "nb_hommes", "nb_femmes", "pct_hommes", "pct_femmes", "ratio_h_f", "age_moyen", "age_median", "nb_centenaires", "nb_mineurs", "indice_survie", "anomalie_distribution"
    )


def by_month(records: DataFrame, limits: Limits = Limits(), exact: bool = True) -> DataFrame:
    """One row per month with change, moving average, seasonality and anomaly flag.

    The median is exact unless ``exact`` is off.
    """
    known = rows.require(records, ["annee_deces", "mois_deces"]).withColumnsRenamed({"annee_deces": "annee", "mois_deces": "mois"})
    stats = {"nb_deces": "count", "age_moyen": "avg", "age_median": "median" if exact else "approx_median", "age_min": "min", "age_max": "max"}
    return finish_month(aggregates.profile(known, ["annee", "mois"], "age_au_deces", _flags(limits), stats), limits)


def finish_month(agg: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Change, moving average, seasonality and anomaly flag of counts by month."""
    agg = _sex_shares(agg)
    agg = agg.withColumn("AnMois", dates.period_key("annee", "mois"))
    agg = windows.period_change(agg, "nb_deces", ["mois"], ["annee"], "variation_vs_n_1", "variation_pct")
    agg = windows.moving_average(agg, "nb_deces", "AnMois", name="moyenne_mobile_12m", few=True)
    agg = windows.seasonality_index(agg, "nb_deces", "annee")
    agg = windows.zscore_flag(agg, "nb_deces", threshold=limits.monthly_z, z_col="z_score", flag_col="anomalie_flag")
    return agg.select(
        "annee", "mois", "AnMois", "nb_deces", "age_moyen", "age_median", "age_min", "age_max", "nb_hommes", "nb_femmes", "pct_hommes", "pct_femmes", "nb_centenaires", "nb_mineurs",
        F.col("variation_vs_n_1").cast("int").alias("variation_vs_n_1"), "variation_pct", "moyenne_mobile_12m", "indice_saisonnalite", "z_score", "anomalie_flag",
    )


def by_place(records: DataFrame, places: DataFrame, limits: Limits = Limits(), exact: bool = True) -> DataFrame:
    """One row per place, with rates by the place's population and area."""
    known = rows.require(records, ["code_lieu_deces"])
    stats = {"nb_deces": "count", "age_moyen_deces": "avg", "age_median_deces": "median" if exact else "approx_median", "age_min": "min", "age_max": "max"}
    return finish_place(aggregates.profile(known, ["code_lieu_deces"], "age_au_deces", _flags(limits, senior=True), stats), places, limits)


def finish_place(agg: DataFrame, places: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rates by population and area, and the anomaly flag, of counts by place."""
    agg = _sex_shares(agg)
    agg = joins.enrich(agg, places, "code_lieu_deces", "id_commune", ["id_commune", "population_commune", "superficie_commune"], pad=5)
    agg = agg.withColumns(
        {
            "id_commune": text.first_non_null(text.zfill("id_commune"), "code_lieu_deces"),
            "taux_mortalite": numbers.rate_per("nb_deces", "population_commune", 1000, 4, limits.least_population),
            "densite_deces": numbers.rate_per("nb_deces", "superficie_commune", 1, 4),
            "indice_vieillissement": numbers.ratio("_nb_seniors", "nb_deces", 100, 2),
        }
    )
    agg = windows.zscore_flag(agg, "taux_mortalite", threshold=limits.z, flag_col="anomalie_mortalite")
    return agg.select(
        "id_commune", "population_commune", "nb_deces", "taux_mortalite", "age_moyen_deces", "age_median_deces", "age_min", "age_max", "nb_hommes", "nb_femmes", "pct_hommes", "pct_femmes",
        "nb_centenaires", "nb_mineurs", "indice_vieillissement", "densite_deces", "anomalie_mortalite",
    )


def by_cohort(records: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per month of birth, age and place."""
    known = rows.require(records, ["date_naissance", "age_au_deces", "code_lieu_deces"])
    keyed = rows.in_range(known.withColumn("annee_naissance", F.year("date_naissance")), "annee_naissance", limits.first_birth, limits.last_birth)
    keyed = keyed.withColumns({"id_date": dates.period_key("annee_naissance", F.month("date_naissance")), "age": F.col("age_au_deces"), "id_commune": text.zfill("code_lieu_deces")})
    span = {"annee_deces_min": F.min("annee_deces"), "annee_deces_max": F.max("annee_deces")}
    return finish_cohort(aggregates.profile(keyed, ["id_date", "annee_naissance", "age", "id_commune"], flags=_flags(limits, senior=True), stats={"nb_deces": "count"}, more=span), limits)


def finish_cohort(agg: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Shares, ages, trend and flags of counts by month of birth, age and place.

    The total and the spreads by age and by year of birth come from one pass over the
    counts; ages and years are few, whatever the records.
    """
    agg = _sex_shares(agg)
    # the group's age is its records' mean, median, least and greatest age
    agg = agg.withColumns({"age_moyen_deces": F.round(F.col("age").cast("double"), 1), "age_median_deces": F.col("age").cast("double"), "age_min": F.col("age"), "age_max": F.col("age")})
    agg = agg.withColumns({"key_generation": rows.composite_key(["id_date", "age", "id_commune"]), "ratio_h_f": numbers.ratio("nb_hommes", "nb_femmes", 1, 3), "indice_vieillissement": numbers.ratio("_nb_seniors", "nb_deces", 100, 2)})
    agg = windows.with_few_spreads(agg, "nb_deces", ["age", "annee_naissance"])
    agg = windows.period_change(agg, "nb_deces", ["annee_naissance", "id_commune"], ["age", "id_date"], None, "tendance_mortalite")
    z = windows.zscore("nb_deces", "__m_annee_naissance", "__s_annee_naissance")
    agg = agg.withColumns(
        {
            "pct_total": numbers.ratio("nb_deces", "__total", 100, 5),
            "surmortalite": F.coalesce(windows.zscore("nb_deces", "__m_age", "__s_age"), F.lit(0.0)),
            "anomalie_generation": F.coalesce(F.abs(z) > limits.z, F.lit(False)),
        }
    )
    return agg.select(
        "id_date", "key_generation", "annee_naissance", "age", "id_commune", "nb_deces", "pct_total", "age_moyen_deces", "age_median_deces", "age_min", "age_max", "nb_hommes", "nb_femmes", "pct_hommes", "pct_femmes",
        "ratio_h_f", "nb_centenaires", "nb_mineurs", "annee_deces_min", "annee_deces_max", "surmortalite", "tendance_mortalite", "indice_vieillissement", "anomalie_generation",
    )


def mart_monthly(monthly: DataFrame) -> DataFrame:
    """The monthly aggregate with labels of its months."""
    return rows.derive(monthly, dates.month_labels("annee", "mois"))


def mart_place(by_place_: DataFrame, places: DataFrame, columns: tuple[str, ...] = ("commune", "departement", "region", "code_region", "type_commune", "epci", "latitude", "longitude", "superficie_commune", "densite_commune")) -> DataFrame:
    """The place aggregate with the place's labels (C11)."""
    return joins.enrich(by_place_, places, "id_commune", "id_commune", [c for c in columns if c in places.columns], pad=5)
