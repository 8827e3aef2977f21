"""Record layers: raw lines to typed records (C1-C4) and dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import dates, numbers, rules, text
from cairn.operators import aggregates, joins, partitions, quality, rows
from cairn.sources import readers, sinks

KEY = ("nom", "prenoms", "date_naissance", "date_deces")
MERGE_KEY = (*KEY, "code_lieu_deces")
RECORD = (
    "nom", "prenoms", "sexe", "date_naissance", "code_lieu_naissance", "commune_naissance", "pays_naissance", "departement_naissance", "_date_naissance_approx",
    "date_deces", "code_lieu_deces", "departement_deces", "num_acte_deces", "_date_deces_approx", "age_au_deces", "annee_deces", "mois_deces", "_source_fichier", "_ingestion_ts",
)


def parsed_records(raw: DataFrame) -> DataFrame:
    """Fixed-width fields with the name split in two."""
    nom, prenoms = text.split_first("nom_prenoms")
    return raw.withColumns({"nom": nom, "prenoms": prenoms})


def bronze(spark: SparkSession, path: str | list[str], target: DataFrame | None = None, run_ts: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Parsed records of all files, merged by key into ``target`` if there is one."""
    staged = parsed_records(readers.read_fixed_width(spark, path, run_ts=run_ts, encoding=encoding))
    return staged if target is None else joins.merge_insert_only(target, staged, MERGE_KEY)[0]


def bronze_into(spark: SparkSession, path: str | list[str], table: str, run_ts: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Merge the parsed records of files by key into a table partitioned by the year of death as written; returns the merge's counts by year.

    Only years that the files have records of are read, and their new records appended.
    """
    staged = parsed_records(readers.read_fixed_width(spark, path, run_ts=run_ts, encoding=encoding))
    return partitions.merge_partitions(spark, table, staged.withColumn("annee", F.substring("date_deces", 1, 4)), MERGE_KEY, ["annee"])


def cleaned(bronze_: DataFrame) -> DataFrame:
    """Cleaned text, mapped codes, no rejects, one row per person."""
    places = {c: text.strip_trailing(text.blank_to_null(text.clean_text(c))) for c in ("commune_naissance", "pays_naissance")}
    names = {"nom": text.strip_trailing(text.clean_text("nom")), "prenoms": text.strip_trailing(text.blank_to_null(text.clean_text("prenoms")))}
    codes = {c: text.zfill(c) for c in ("code_lieu_naissance", "code_lieu_deces")}
    clean = rows.derive(bronze_, {**names, **places, **codes, "sexe": text.map_codes("sexe", {"1": "M", "2": "F"})})
    return aggregates.dedup(rows.split_rejects(clean, rows.valid_day("date_deces"))[0], KEY)


def normalised(clean: DataFrame) -> DataFrame:
    """Typed records: dates, approximation flags, age, periods, departments."""
    flags = {f"_{c}_approx": dates.approx_flag(c) for c in ("date_naissance", "date_deces")}
    typed = clean.withColumns(flags).withColumns({c: dates.approx_date(c) for c in ("date_naissance", "date_deces")})
    out = typed.withColumns(
        {
            "age_au_deces": dates.age_years("date_naissance", "date_deces"),
            "annee_deces": dates.year_of("date_deces"),
            "mois_deces": dates.month_of("date_deces"),
            "departement_naissance": text.region_prefix("code_lieu_naissance"),
            "departement_deces": text.region_prefix("code_lieu_deces"),
        }
    )
    return out.select(*RECORD)


def validated(records: DataFrame, columns: Sequence[str] = ("age_au_deces", "sexe", "date_naissance")) -> tuple[DataFrame, DataFrame]:
    """The records as they are, and one report on them: ``report, item, value`` of null rates, ages by decade, approximate dates and filled columns (C4)."""
    nulls = quality.compute_null_rates(records, columns).select(F.lit("null_pct").alias("report"), F.col("column").alias("item"), F.col("null_pct").alias("value"))
    ages = quality.decade_distribution(records, "age_au_deces").select(F.lit("decade").alias("report"), F.col("tranche").alias("item"), F.col("n").cast("double").alias("value"))
    filled = quality.fill_report(records, ["_date_naissance_approx", "_date_deces_approx"], ["commune_naissance", "pays_naissance"])
    fill = filled.select(F.explode(F.array(*(F.struct(F.lit("fill").alias("report"), F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in filled.columns))).alias("x")).select("x.*")
    return records, rows.union_all([nulls, ages, fill])


def place_table(spark: SparkSession, path: str, new: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """The place dimension after an upsert of ``new`` into ``held``, written clustered by its key."""
    merged = new if held is None else joins.merge_upsert(held, new, ["id_commune"])[0]
    sinks.rewrite_clustered(merged, path, ["id_commune"])
    return spark.read.parquet(path)


def dim_age(spark: SparkSession, last: int = rules.MAX_AGE) -> DataFrame:
    """One row per age 0..last with its bands."""
    age = F.col("age")
    bands = {name: rules.rules_case(age, band) for name, band in rules.AGE_BANDS.items()}
    more = {"age_key": age, "majeur_flag": age >= 18, "centenaire_flag": age >= 100, "ordre_tranche": rules.rules_case(age, rules.BAND_ORDER, 99)}
    return readers.range_table(spark, 0, last, "age").withColumns({**bands, **more}).select("age_key", "age", *bands, "majeur_flag", "centenaire_flag", "ordre_tranche")


def dim_date(spark: SparkSession, start: date = date(2010, 1, 1), end: date = date(2030, 12, 31)) -> DataFrame:
    """One row per day."""
    return readers.calendar(spark, start, end, "day").select(*(c.alias(n) for n, c in dates.calendar_columns("day").items()))


def dim_generation(spark: SparkSession, generations: Sequence[rules.Rule] = rules.GENERATIONS) -> DataFrame:
    """One row per birth year of the known generations (C14)."""
    return readers.range_table(spark, generations[0][0], generations[-1][1], "annee_naissance").withColumn("generation", rules.rules_case("annee_naissance", tuple(generations)))


def dim_place(places: DataFrame, departments: DataFrame, regions: DataFrame, observations: DataFrame, this_year: int, years: int = 10) -> DataFrame:
    """Places with names, the latest observed population and its density.

    ``departments`` has code_departement, departement; ``regions`` code_region, region.
    Observations older than ``years`` do not count; without one the place's own figure does.
    """
    recent = aggregates.latest(observations.where((F.col("time_period") > this_year - years) & F.col("population").isNotNull()), ["geo"], "time_period", ["population"])
    joined = joins.enrich(places, departments, "code_departement", "code_departement", ["departement"])
    joined = joins.enrich(joined, regions, "code_region", "code_region", ["region"])
    joined = joins.enrich(joined, recent, "id_commune", "geo", ["population"])
    out = joined.withColumn("population_commune", text.first_non_null("population", "population_api"))
    return out.withColumn("densite_commune", numbers.density("population_commune", "superficie_commune")).select(
        "id_commune", "commune", "departement", "region", "code_region", "latitude", "longitude", "population_commune", "superficie_commune", "densite_commune", "type_commune", "epci"
    )
