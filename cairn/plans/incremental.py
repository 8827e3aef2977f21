"""Aggregates kept up to date from additive states instead of all records (C6-C9 after S6).

A state table holds, for each group at a fine grain, what can be added up: counts, and
least and greatest values. A delivery of records becomes states of its own in the folder
``delivery=<id>``, so taking the same delivery in again replaces it. The aggregates and
their window metrics are made from the states of all deliveries; records of earlier
deliveries are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import dates, text
from cairn.operators import rows
from cairn.plans import gold


@dataclass(frozen=True)
class States:
    """Groups (names and SQL expressions), and the columns whose least or greatest value is kept beside the count ``n``."""

    keys: Mapping[str, str]
    least: Mapping[str, str] = field(default_factory=dict)
    most: Mapping[str, str] = field(default_factory=dict)

    def of(self, records: DataFrame) -> DataFrame:
        """The states of records."""
        kept = {**{n: F.min(c) for n, c in self.least.items()}, **{n: F.max(c) for n, c in self.most.items()}}
        return records.groupBy(*(F.expr(c).alias(n) for n, c in self.keys.items())).agg(F.count(F.lit(1)).alias("n"), *(c.alias(n) for n, c in kept.items()))

    def merged(self, states: DataFrame) -> DataFrame:
        """One row a group from the states of several deliveries."""
        kept = {**{n: F.min(n) for n in self.least}, **{n: F.max(n) for n in self.most}}
        return states.groupBy(*self.keys).agg(F.sum("n").alias("n"), *(c.alias(n) for n, c in kept.items()))


#: Ages by month: for the aggregates by age and by month.
AGES = States({c: c for c in ("annee_deces", "mois_deces", "age_au_deces", "sexe")})
#: Ages by place.
PLACES = States({c: c for c in ("code_lieu_deces", "age_au_deces", "sexe")})
#: Ages by month of birth and place, with the first and last year of death.
COHORTS = States({"annee_naissance": "year(date_naissance)", "mois_naissance": "month(date_naissance)", "age_au_deces": "age_au_deces", "code_lieu_deces": "code_lieu_deces", "sexe": "sexe"}, least={"annee_min": "annee_deces"}, most={"annee_max": "annee_deces"})


def deliver(spark: SparkSession, path: str, delivery: str, records: DataFrame, states: States) -> None:
    """Add the states of a delivery to the table at ``path``; one that is there under this id is replaced."""
    found = states.of(records).withColumn("delivery", F.lit(delivery))
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery").parquet(path)


def stored(spark: SparkSession, path: str, states: States) -> DataFrame:
    """The states of all deliveries, one row a group."""
    return states.merged(spark.read.parquet(path))


def compacted(spark: SparkSession, path: str, to: str, states: States, delivery: str = "base") -> None:
    """Write the states of all deliveries as one delivery of another table."""
    stored(spark, path, states).withColumn("delivery", F.lit(delivery)).write.partitionBy("delivery").parquet(to)


def by_age(states: DataFrame, limits: gold.Limits = gold.Limits()) -> DataFrame:
    """C6 from AGES."""
    known = rows.require(states, ["age_au_deces", "annee_deces", "mois_deces"])
    keyed = known.withColumns({"age": F.col("age_au_deces"), "id_date": dates.period_key("annee_deces", "mois_deces")})
    return gold.finish_age(gold.profile_of_states(keyed, ["age", "id_date"], limits), limits)


def by_month(states: DataFrame, limits: gold.Limits = gold.Limits()) -> DataFrame:
    """C7 from AGES; the median is exact, as the states hold every age's count."""
    known = rows.require(states, ["annee_deces", "mois_deces"]).withColumnsRenamed({"annee_deces": "annee", "mois_deces": "mois"})
    ages = {"age_moyen": "avg", "age_median": "median", "age_min": "min", "age_max": "max"}
    return gold.finish_month(gold.profile_of_states(known, ["annee", "mois"], limits, ages), limits)


def by_place(states: DataFrame, places: DataFrame, limits: gold.Limits = gold.Limits()) -> DataFrame:
    """C8 from PLACES."""
    ages = {"age_moyen_deces": "avg", "age_median_deces": "median", "age_min": "min", "age_max": "max"}
    return gold.finish_place(gold.profile_of_states(rows.require(states, ["code_lieu_deces"]), ["code_lieu_deces"], limits, ages, senior=True), places, limits)


def by_cohort(states: DataFrame, limits: gold.Limits = gold.Limits()) -> DataFrame:
    """C9 from COHORTS."""
    known = rows.in_range(rows.require(states, ["annee_naissance", "age_au_deces", "code_lieu_deces"]), "annee_naissance", limits.first_birth, limits.last_birth)
    keyed = known.withColumns({"id_date": dates.period_key("annee_naissance", "mois_naissance"), "age": F.col("age_au_deces"), "id_commune": text.zfill("code_lieu_deces")})
    span = {"annee_deces_min": F.min("annee_min"), "annee_deces_max": F.max("annee_max")}
    return gold.finish_cohort(gold.profile_of_states(keyed, ["id_date", "annee_naissance", "age", "id_commune"], limits, senior=True, more=span), limits)
