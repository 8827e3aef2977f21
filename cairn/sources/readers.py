"""Scans and generated sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The half-open character ranges of a death record line.
DEATH_RECORD = {
    "nom_prenoms": (0, 80),
    "sexe": (80, 81),
    "date_naissance": (81, 89),
    "code_lieu_naissance": (89, 94),
    "commune_naissance": (94, 124),
    "pays_naissance": (124, 154),
    "date_deces": (154, 162),
    "code_lieu_deces": (162, 167),
    "num_acte_deces": (167, 176),
}
MIN_LENGTH = 162
#: The years of each environment.
YEARS = {"dev": range(2023, 2026), "test": range(2020, 2026), "prod": range(2015, 2026)}


def valid_length(c: Column | str, least: int = MIN_LENGTH, most: int | None = None) -> Column:
    """Whether a line has between ``least`` and ``most`` characters; null is not valid (S3)."""
    n = F.length(F.col(c) if isinstance(c, str) else c)
    return F.coalesce(n >= least if most is None else n.between(least, most), F.lit(False))


def slice_fields(lines: DataFrame, positions: Mapping[str, tuple[int, int]] = DEATH_RECORD, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Trimmed fields by half-open character ranges; beyond the line's end a field is what is left of it."""
    return lines.select(*keep, *(F.trim(F.substring(value, lo + 1, hi - lo)).alias(name) for name, (lo, hi) in positions.items()))


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """``value, _file``: the lines of text files. Other encodings than UTF-8 go through the CSV reader, which decodes them."""
    if encoding.upper().replace("-", "") == "UTF8":
        raw = spark.read.text(path)
    else:
        raw = spark.read.schema("value string").option("encoding", encoding).option("sep", "\x01").option("quote", "").csv(path)
    return raw.select("value", F.col("_metadata.file_name").alias("_file"))


def read_fixed_width(spark: SparkSession, path: str | list[str], positions: Mapping[str, tuple[int, int]] = DEATH_RECORD, min_len: int = MIN_LENGTH, encoding: str = "UTF-8", run_ts: datetime | None = None) -> DataFrame:
    """Fixed-width lines as columns; shorter lines than ``min_len`` are left out."""
    good = read_lines(spark, path, encoding).where(valid_length("value", min_len))
    return with_lineage(slice_fields(good, positions, keep=["_file"]), run_ts)


def with_lineage(df: DataFrame, run_ts: datetime | str | None = None, file_col: str = "_file") -> DataFrame:
    """The source file's name and one ingestion time for the whole run."""
    ts = F.lit(run_ts if run_ts is not None else datetime.now()).cast("string")
    return df.withColumns({"_source_fichier": F.col(file_col), "_ingestion_ts": ts}).drop(file_col)


def select_sources(listing: DataFrame, pattern: str = r"^deces-(\d{4})\.txt$", years: Sequence[int] | None = None, title: str = "title") -> DataFrame:
    """Rows whose title matches (any case) with a wanted year, and the year; monthly and quarterly files do not match."""
    year = F.regexp_extract(F.lower(title), pattern, 1).try_cast("int")
    found = listing.withColumn("annee", year).where(F.col("annee").isNotNull())
    return found if years is None else found.where(F.col("annee").isin(list(years)))


def ingest_new(listing: DataFrame, ledger: DataFrame, key: str = "title") -> DataFrame:
    """Sources that the ledger does not hold."""
    return listing.join(ledger.select(key).distinct(), key, "left_anti")


def ingest_ledger(listing: DataFrame, lines: DataFrame, min_len: int = MIN_LENGTH, inserted: DataFrame | None = None, title: str = "title") -> DataFrame:
    """Per source: raw, parsed and rejected lines; with ``inserted`` (rows with _source_fichier) also inserted and ignored ones."""
    counts = lines.groupBy(F.col("_file").alias(title)).agg(F.count(F.lit(1)).alias("lignes_brutes"), F.count_if(valid_length("value", min_len)).alias("lignes_parsees"))
    out = listing.join(counts, title, "left").fillna(0, ["lignes_brutes", "lignes_parsees"]).withColumn("lignes_rejetees", F.col("lignes_brutes") - F.col("lignes_parsees"))
    if inserted is not None:
        new = inserted.groupBy(F.col("_source_fichier").alias(title)).agg(F.count(F.lit(1)).alias("lignes_inserees"))
        out = out.join(new, title, "left").fillna(0, ["lignes_inserees"]).withColumn("lignes_ignorees", F.col("lignes_parsees") - F.col("lignes_inserees"))
    return out


def read_table(spark: SparkSession, ref: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A table by path (with a slash) or by name, with the wanted columns only."""
    df = spark.read.parquet(ref) if "/" in ref else spark.table(ref)
    return df.select(*cols) if cols else df


PLACE = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("nom", T.StringType()),
        T.StructField("codeDepartement", T.StringType()),
        T.StructField("codeRegion", T.StringType()),
        T.StructField("centre", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
        T.StructField("surface", T.DoubleType()),
        T.StructField("population", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("epci", T.StructType([T.StructField("nom", T.StringType())])),
    ]
)


def read_places_json(spark: SparkSession, path: str) -> DataFrame:
    """One row per place of a JSON array; missing parts are null."""
    raw = spark.read.schema(PLACE).option("multiLine", True).json(path)
    at = F.col("centre.coordinates")
    return raw.select(
        F.col("code").alias("id_commune"), F.col("nom").alias("commune"), F.col("codeDepartement").alias("code_departement"), F.col("codeRegion").alias("code_region"),
        F.get(at, F.lit(1)).alias("latitude"), F.get(at, F.lit(0)).alias("longitude"), F.col("surface").alias("superficie_commune"),
        F.col("population").alias("population_api"), F.col("type").alias("type_commune"), F.col("epci.nom").alias("epci"),
    )


def read_observations_json(spark: SparkSession, path: str) -> DataFrame:
    """``geo, time_period, population``: one row per observation; values that are no numbers are null."""
    schema = "observations array<struct<dimensions:struct<GEO:string,TIME_PERIOD:string>,measures:struct<OBS_VALUE_NIVEAU:struct<value:string>>>>"
    each = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("observations").alias("o"))
    return each.select(F.col("o.dimensions.GEO").alias("geo"), F.col("o.dimensions.TIME_PERIOD").try_cast("int").alias("time_period"), F.col("o.measures.OBS_VALUE_NIVEAU.value").try_cast("double").cast("long").alias("population"))


def read_code_list(spark: SparkSession, path: str, code: str, name: str) -> DataFrame:
    """A list of codes and names under the wanted column names."""
    return spark.read.schema("code string, nom string").option("multiLine", True).json(path).select(F.col("code").alias(code), F.col("nom").alias(name))


def range_table(spark: SparkSession, lo: int, hi: int, name: str) -> DataFrame:
    """The integers lo..hi."""
    return spark.range(lo, hi + 1).select(F.col("id").cast("int").alias(name))


def calendar(spark: SparkSession, start: date, end: date, name: str = "date") -> DataFrame:
    """The days start..end."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias(name))


def assert_not_empty(df: DataFrame, name: str) -> DataFrame:
    """The same frame; raises if it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def safe_read(spark: SparkSession, ref: str, cols: Sequence[str] | None = None) -> DataFrame | None:
    """The table, or None if it is missing."""
    try:
        return read_table(spark, ref, cols)
    except AnalysisException:
        return None


def safe_count(spark: SparkSession, ref: str, where: str | None = None) -> int:
    """Rows of a table (that fulfil ``where``), -1 if it is missing."""
    df = safe_read(spark, ref)
    if df is None:
        return -1
    return df.where(where).count() if where else df.count()
