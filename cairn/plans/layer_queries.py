"""Queries over files written from the given tables, over the record layers, and of ordered results.

Shipped lines become death records of fixed width: the order's customer is the name, the
supplier the place. Every seventh order has a birth date without a day, every eleventh
none, every thirteenth no death date, every seventeenth a line that is too short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import rules, text
from cairn.operators import aggregates, joins, quality, rows, windows
from cairn.plans import gold, layers, monitoring
from cairn.plans import queries as core
from cairn.plans.queries import _query, _t
from cairn.sources import readers, sinks
from cairn.sources.scratch import delete, scratch_path, shuffles_removed
from cairn.streaming import ingest

RUN = "2024-05-01 00:00:00"


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of a death record for every shipped line."""
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    both = _t(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    order, day = F.col("l_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    s = lambda *cols: F.concat(*(c if isinstance(c, Column) else F.col(c).cast("string") for c in cols))
    return both.select(
        order.alias("k"), F.year("l_shipdate").alias("annee"),
        s(F.lit("C"), "o_custkey", F.lit("*p"), "l_orderkey", F.lit(" "), "l_linenumber", F.lit(" "), "l_partkey", F.lit(" "), "l_suppkey", F.lit(" "), F.col("l_quantity").cast("int").cast("string"), F.when(F.col("l_partkey") % 3 == 0, "/").otherwise("")).alias("nom_prenoms"),
        text.map_codes("l_returnflag", {"R": "1", "A": "2", "N": "9"}).alias("sexe"),
        F.when(order % 11 == 0, "00000000").when(order % 7 == 0, F.concat(F.substring(day, 1, 6), F.lit("00"))).otherwise(day).alias("date_naissance"),
        text.zfill("l_suppkey").alias("code_lieu_naissance"), s(F.lit("ville "), (F.col("l_partkey") % 50).cast("string")).alias("commune_naissance"), F.when(F.col("l_partkey") % 5 == 0, "pays").otherwise("").alias("pays_naissance"),
        F.when(order % 13 == 0, "00000000").otherwise(F.date_format("l_shipdate", "yyyyMMdd")).alias("date_deces"),
        text.zfill("l_suppkey").alias("code_lieu_deces"), F.col("l_linenumber").cast("string").alias("num_acte_deces"),
    )


def _lines(spark: SparkSession, sf: str, where: str | None = None) -> DataFrame:
    raw = _raw(spark, sf) if where is None else _raw(spark, sf).where(where)
    line = F.concat(*(F.rpad(c, hi - lo, " ") for c, (lo, hi) in readers.DEATH_RECORD.items()))
    return raw.select(F.when(F.col("k") % 17 == 0, F.substring(line, 1, 161)).otherwise(line).alias("value"))


def _written(spark: SparkSession, sf: str, where: str | None = None) -> str:
    path = scratch_path(spark, "lines")
    with shuffles_removed(spark):
        _lines(spark, sf, where).write.text(path, compression="gzip")
    return path


_D = """d AS (SELECT l_orderkey AS k, CAST(l_quantity AS INTEGER) AS q, l_partkey, l_suppkey, l_linenumber, 'C' || o_custkey AS nom, 'p' || l_orderkey || ' ' || l_linenumber || ' ' || l_partkey || ' ' || l_suppkey || ' ' || CAST(l_quantity AS INTEGER) AS prenoms,
  CASE l_returnflag WHEN 'R' THEN 'M' WHEN 'A' THEN 'F' END AS sexe, CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' ELSE '9' END AS sexe_code, CAST(o_orderdate AS DATE) AS od, CAST(l_shipdate AS DATE) AS sd, lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 17 <> 0)"""
_TYPED = f"""{_D}, t AS (SELECT DISTINCT nom, upper(prenoms) AS prenoms, sexe, CASE WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 0 THEN CAST(date_trunc('month', od) AS DATE) ELSE od END AS birth, k % 11 = 0 OR k % 7 = 0 AS ba, sd, code,
  'VILLE ' || (l_partkey % 50) AS commune, CASE WHEN l_partkey % 5 = 0 THEN 'PAYS' END AS pays, CAST(l_linenumber AS VARCHAR) AS acte FROM d WHERE k % 13 <> 0), n AS (
  SELECT *, CASE WHEN sd >= birth THEN CAST(floor(date_diff('day', birth, sd) / 365.25) AS INTEGER) END AS age, CASE WHEN code[1:2] IN ('97', '98') THEN code[1:3] ELSE code[1:2] END AS dep FROM t)"""


@_query("scan_fixed_width", f"WITH {_D} SELECT sexe_code AS sexe, count(*) AS n, count(DISTINCT nom) AS noms, min(CASE WHEN k % 13 = 0 THEN '00000000' ELSE strftime(sd, '%Y%m%d') END) AS first_day, max(code) AS last_code, count(*) AS with_file, CAST(1 AS BIGINT) AS runs FROM d GROUP BY 1")
def scan_fixed_width(spark: SparkSession, sf: str) -> DataFrame:
    """Files of fixed-width lines written and scanned, with their lineage."""
    found = layers.parsed_records(readers.read_fixed_width(spark, _written(spark, sf), run_ts=RUN))
    return found.groupBy("sexe").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("nom").alias("noms"), F.min("date_deces").alias("first_day"), F.max("code_lieu_deces").alias("last_code"), F.count_if(F.col("_source_fichier").endswith(".txt.gz")).alias("with_file"), F.count_distinct("_ingestion_ts").alias("runs"))


@_query(
    "bronze_layer",
    f"WITH {_D}, a AS (SELECT * FROM d WHERE k % 3 <> 0), b AS (SELECT DISTINCT nom, prenoms, sexe_code, k, sd, code FROM d WHERE k % 2 = 0 AND k % 3 = 0) SELECT sexe_code AS sexe, count(*) AS n, count(DISTINCT prenoms) AS prenoms FROM (SELECT sexe_code, prenoms FROM a UNION ALL SELECT sexe_code, prenoms FROM b) GROUP BY 1",
)
def bronze_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of files, the second merged into the first by key."""
    first = layers.bronze(spark, _written(spark, sf, "k % 3 <> 0"), run_ts=RUN)
    both = layers.bronze(spark, _written(spark, sf, "k % 2 = 0"), target=first, run_ts=RUN)
    return both.withColumn("prenoms", F.regexp_replace("prenoms", "/$", "")).groupBy("sexe").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("prenoms").alias("prenoms"))


@_query(
    "bronze_table",
    f"""WITH {_D}, u AS (SELECT DISTINCT nom, prenoms, k, CASE WHEN k % 13 <> 0 THEN sd END AS sd, code FROM d)
    SELECT CAST(1 AS INTEGER) AS livraison, count(*) AS inserted, CAST(0 AS BIGINT) AS ignored FROM u WHERE k % 3 <> 0 UNION ALL SELECT 2, count(*) FILTER (k % 3 = 0), count(*) FILTER (k % 3 <> 0) FROM u WHERE k % 2 = 0""",
)
def bronze_table(spark: SparkSession, sf: str) -> DataFrame:
    """What two deliveries of files added to a table by year."""
    table, out = scratch_path(spark, "bronze"), []
    for n, where in ((1, "k % 3 <> 0"), (2, "k % 2 = 0")):
        lines = _written(spark, sf, where)
        counts = layers.bronze_into(spark, lines, table, run_ts=RUN)
        delete(spark, lines)
        out.append(counts.agg(F.lit(n).alias("livraison"), F.sum("inserted").alias("inserted"), F.sum("ignored").alias("ignored")))
    return rows.union_all(out)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return layers.cleaned(layers.bronze(spark, _written(spark, sf), run_ts=RUN))


@_query(
    "clean_layer",
    f"WITH {_D} SELECT DISTINCT nom, upper(prenoms) AS prenoms, sexe, CASE WHEN k % 11 = 0 THEN '00000000' WHEN k % 7 = 0 THEN strftime(od, '%Y%m') || '00' ELSE strftime(od, '%Y%m%d') END AS date_naissance, 'VILLE ' || (l_partkey % 50) AS commune_naissance, CASE WHEN l_partkey % 5 = 0 THEN 'PAYS' END AS pays_naissance, strftime(sd, '%Y%m%d') AS date_deces, code AS code_lieu_deces FROM d WHERE k % 13 <> 0",
)
def clean_layer(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf).select("nom", "prenoms", "sexe", "date_naissance", "commune_naissance", "pays_naissance", "date_deces", "code_lieu_deces")


@_query(
    "normalised_layer",
    f"""WITH {_TYPED} SELECT nom, prenoms, sexe, CAST(birth AS VARCHAR) AS date_naissance, code AS code_lieu_naissance, commune AS commune_naissance, pays AS pays_naissance, dep AS departement_naissance, ba AS _date_naissance_approx, CAST(sd AS VARCHAR) AS date_deces, code AS code_lieu_deces,
    dep AS departement_deces, acte AS num_acte_deces, false AS _date_deces_approx, age AS age_au_deces, CAST(year(sd) AS INTEGER) AS annee_deces, CAST(month(sd) AS INTEGER) AS mois_deces FROM n""",
)
def normalised_layer(spark: SparkSession, sf: str) -> DataFrame:
    typed = layers.normalised(clean(spark, sf)).drop("_source_fichier", "_ingestion_ts")
    return typed.withColumns({c: F.col(c).cast("string") for c in ("date_naissance", "date_deces")})


@_query(
    "validated_layer",
    f"""WITH {_TYPED}, c AS (SELECT count(*) AS n, count(age) AS a, count(sexe) AS s, count(birth) AS b, count(*) FILTER (ba) AS f, count(commune) AS co, count(pays) AS p FROM n)
    SELECT 'null_pct' AS report, unnest(['age_au_deces', 'sexe', 'date_naissance']) AS item, unnest([round((n - a) * 100.0::DOUBLE / n, 2), round((n - s) * 100.0::DOUBLE / n, 2), round((n - b) * 100.0::DOUBLE / n, 2)]) AS value FROM c
    UNION ALL SELECT 'decade', (age // 10 * 10) || '-' || (age // 10 * 10 + 9), CAST(count(*) AS DOUBLE) FROM n GROUP BY 2
    UNION ALL SELECT 'fill', unnest(['n_rows', 'n_date_naissance_approx', 'n_date_deces_approx', 'pct_commune_naissance', 'pct_pays_naissance']), unnest([n::DOUBLE, f::DOUBLE, 0.0, round(co * 100.0::DOUBLE / n, 2), round(p * 100.0::DOUBLE / n, 2)]) FROM c""",
)
def validated_layer(spark: SparkSession, sf: str) -> DataFrame:
    return layers.validated(layers.normalised(clean(spark, sf)))[1]


@_query(
    "source_ledger",
    """WITH x AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS annee, l_orderkey % 17 = 0 AS short FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))
    SELECT 'deces-' || annee || '.txt' AS title, annee, count(*) AS lignes_brutes, count(*) FILTER (NOT short) AS lignes_parsees, count(*) FILTER (short) AS lignes_rejetees FROM x WHERE annee BETWEEN 1995 AND 1999 AND annee % 4 <> 0 GROUP BY annee""",
)
def source_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Sources picked by title and year that the ledger does not hold, and the lines of each."""
    year = F.year("l_shipdate")
    years = _t(spark, sf, "lineitem").select(year.alias("y")).distinct()
    names = F.array(F.concat(F.lit("deces-"), "y", F.lit(".txt")), F.concat(F.lit("deces-"), "y", F.lit("m05.txt")), F.concat(F.lit("deces-"), "y", F.lit("t1.txt")), F.lit("readme.txt"))
    listing = years.select(F.explode(names).alias("title")).distinct()
    chosen = readers.assert_not_empty(readers.select_sources(listing, years=range(1995, 2000)), "sources")
    ledger = listing.where(F.regexp_extract("title", r"^deces-(\d{4})\.txt$", 1).try_cast("int") % 4 == 0)
    raw = _raw(spark, sf)
    line = F.when(F.col("k") % 17 == 0, F.repeat(F.lit("x"), 161)).otherwise(F.repeat(F.lit("x"), 176))
    lines = raw.select(line.alias("value"), F.concat(F.lit("deces-"), "annee", F.lit(".txt")).alias("_file"))
    return readers.ingest_ledger(readers.ingest_new(chosen, ledger), lines)


@_query("incremental_ingest", f"WITH {_D} SELECT sexe_code AS sexe, count(DISTINCT (nom, prenoms, code)) AS n FROM d WHERE k % 3 <> 0 OR k % 2 = 0 GROUP BY 1")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries into one folder, each taken in by a run of the stream; then a run that has forgotten its progress takes all of them in again."""
    keys, by = ["nom_prenoms", "date_naissance", "date_deces", "code_lieu_deces"], {"annee": F.substring("date_deces", 1, 4)}
    folder, target, checkpoint = scratch_path(spark, "lines"), scratch_path(spark, "records"), scratch_path(spark, "progress")
    for where in ("k % 3 <> 0", "k % 2 = 0"):
        with shuffles_removed(spark):
            _lines(spark, sf, where).write.mode("append").text(folder, compression="gzip")
        ingest.ingest_available(spark, folder, target, checkpoint, keys, by)
    ingest.ingest_available(spark, folder, target, scratch_path(spark, "progress"), keys, by)
    held = readers.read_table(spark, target, ["sexe", "_source_fichier"])
    return held.where("_source_fichier IS NOT NULL").groupBy("sexe").agg(F.count(F.lit(1)).alias("n"))


def _array_files(spark: SparkSession, df: DataFrame, by: str, value: Column, rows_: int = 500) -> str:
    """JSON documents of about ``rows_`` values of one ``by`` each, every one in a file of its own."""
    path = scratch_path(spark, "json")
    parts = -(-df.count() // rows_)
    part = F.pmod(F.xxhash64("x"), F.lit(parts)).cast("int").alias("part")
    df.groupBy(by, part).agg(F.to_json(value).alias("value")).select("value", by, "part").repartition(by, "part").write.partitionBy(by, "part").text(path)
    return path


@_query(
    "place_dimension",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id_commune, s_name AS commune, n_name AS departement, r_name AS region, CAST(r_regionkey AS VARCHAR) AS code_region, CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey / 2.0 END::DOUBLE AS latitude, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey / 4.0 END::DOUBLE AS longitude,
    CAST(CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey * 3 ELSE s_suppkey * 10 + 2 END AS BIGINT) AS population_commune, s_suppkey / 8.0::DOUBLE AS superficie_commune, round(CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey * 3 ELSE s_suppkey * 10 + 2 END / (s_suppkey / 8.0::DOUBLE), 1) AS densite_commune,
    CASE WHEN s_suppkey % 7 = 0 THEN 'nouveau' ELSE 'commune' END AS type_commune, CASE WHEN s_suppkey % 3 = 0 THEN 'E' || s_nationkey END AS epci FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def place_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON written from suppliers and scanned, joined to code lists and observations, merged into an earlier version, written clustered."""
    nation = _t(spark, sf, "nation")
    s = _t(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    k, code = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    place = F.struct(
        code.alias("code"), F.col("s_name").alias("nom"), F.col("n_nationkey").cast("string").alias("codeDepartement"), F.col("n_regionkey").cast("string").alias("codeRegion"),
        F.when(k % 4 != 0, F.struct(F.array((k / 4).cast("double"), (F.col("s_nationkey") / 2).cast("double")).alias("coordinates"))).alias("centre"), (k / 8).cast("double").alias("surface"),
        (k * 3).alias("population"), F.when(k % 7 == 0, "nouveau").otherwise("commune").alias("type"), F.when(k % 3 == 0, F.struct(F.concat(F.lit("E"), "s_nationkey").alias("nom"))).alias("epci"),
    )
    seen = lambda year, v: F.struct(F.struct(code.alias("GEO"), F.lit(str(year)).alias("TIME_PERIOD")).alias("dimensions"), F.struct(F.struct(v.cast("string").alias("value")).alias("OBS_VALUE_NIVEAU")).alias("measures"))
    each = F.array(seen(2021, k * 10 + 1), seen(2022, k * 10 + 2), seen(2001, k), seen(2023, F.lit("-")))
    places = readers.read_places_json(spark, _array_files(spark, s.withColumn("x", place), "n_nationkey", F.collect_list("x")))
    held = s.where(k % 5 != 0).withColumn("x", F.explode(each))
    seen_ = readers.read_observations_json(spark, _array_files(spark, held, "n_nationkey", F.struct(F.collect_list("x").alias("observations"))))
    names = lambda df, key, name: df.withColumn("x", F.struct(F.col(key).cast("string").alias("code"), F.col(name).alias("nom")))
    departments = readers.read_code_list(spark, _array_files(spark, names(nation, "n_nationkey", "n_name"), "n_regionkey", F.collect_list("x")), "code_departement", "departement")
    regions = readers.read_code_list(spark, _array_files(spark, names(_t(spark, sf, "region"), "r_regionkey", "r_name"), "r_regionkey", F.collect_list("x")), "code_region", "region")
    new = layers.dim_place(places, departments, regions, seen_, 2024)
    before = new.where("CAST(id_commune AS INT) % 2 = 0").withColumn("type_commune", F.lit("commune"))
    return layers.place_table(spark, scratch_path(spark, "places"), new, layers.place_table(spark, scratch_path(spark, "places"), before))


@_query("run_row", "SELECT 'r1' AS run_id, 'gold' AS pipeline, 'dev' AS environnement, (SELECT count(*) FROM lineitem) AS nb_bronze, (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'N') AS nb_silver, (SELECT count(*) FROM orders) AS nb_fact, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS nb_anomalies_age, CAST(NULL AS BIGINT) AS nb_anomalies_temporel, CAST(NULL AS BIGINT) AS nb_anomalies_geographie, CAST(NULL AS BIGINT) AS nb_anomalies_generation, round((SELECT count(*) FILTER (l_returnflag = 'N') * 100.0::DOUBLE / count(*) FROM lineitem), 4) AS taux_rejet_pct, 'success' AS statut, CAST(NULL AS VARCHAR) AS notes")
def run_row(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    sinks.write_table(_t(spark, sf, "lineitem").where("l_returnflag <> 'N'"), path)
    refs = {"bronze": f"{sf}/lineitem.parquet", "silver": path, "fact": f"{sf}/orders.parquet"}
    return monitoring.run_row(spark, "r1", None, refs, {"age": (f"{sf}/customer.parquet", "c_acctbal < 0"), "temporel": (f"{path}-none", "x")}).drop("run_timestamp")


# writers
@_query("evolved_table", "SELECT n_nationkey AS k, n_name AS name, CAST(NULL AS INTEGER) AS region FROM nation UNION ALL SELECT n_nationkey + 100, n_name, n_regionkey FROM nation")
def evolved_table(spark: SparkSession, sf: str) -> DataFrame:
    """An empty table made from a schema, then appended to twice, with one more column in the end."""
    path, n = scratch_path(spark, "evolved"), _t(spark, sf, "nation")
    sinks.init_table_if_needed(spark, path, "k int, name string")
    sinks.init_table_if_needed(spark, path, "k int, name string")
    sinks.append_table(n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), path)
    sinks.append_table(n.select((F.col("n_nationkey") + 100).alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), path)
    return sinks.read_evolved(spark, path)


@_query("partitioned_table", f"WITH {core._R} SELECT annee AS annee_deces, count(*) AS n, sum(age) AS ages FROM r WHERE annee >= 1998 GROUP BY 1")
def partitioned_table(spark: SparkSession, sf: str) -> DataFrame:
    """Records in one folder a year, of which only the wanted ones are read; written twice, the second time over the first."""
    path, r = scratch_path(spark, "by-year"), core.records(spark, sf).select("annee_deces", "age_au_deces")
    sinks.write_table(r.limit(10), path)
    sinks.write_table(r, path, partition_by=["annee_deces"])
    return readers.read_table(spark, path).where("annee_deces >= 1998").groupBy("annee_deces").agg(F.count(F.lit(1)).alias("n"), F.sum("age_au_deces").alias("ages"))


@_query("named_tables", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def named_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A table registered by its path and one saved in the warehouse, both read by name with a part of their columns."""
    path, tag = scratch_path(spark, "registered"), scratch_path(spark, "t").rpartition("-")[2]
    sinks.write_table(_t(spark, sf, "customer"), path)
    sinks.register(spark, f"customer_{tag}", path)
    sinks.save_managed(_t(spark, sf, "nation"), f"nation_{tag}")
    customer = readers.read_table(spark, f"customer_{tag}", ["c_custkey", "c_name", "c_nationkey"])
    return customer.join(readers.read_table(spark, f"nation_{tag}", ["n_nationkey", "n_name"]), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


# orders, filters, checks
def _months(spark: SparkSession, sf: str) -> DataFrame:
    return core.records(spark, sf).groupBy("annee_deces", "mois_deces").agg(F.count(F.lit(1)).alias("n"))


@_query("ordered_by_keys", f"WITH {core._R} SELECT annee AS annee_deces, mois AS mois_deces, count(*) AS n, row_number() OVER (ORDER BY annee, mois) AS position FROM r GROUP BY 1, 2")
def ordered_by_keys(spark: SparkSession, sf: str) -> DataFrame:
    return rows.with_position(_months(spark, sf), ["annee_deces", "mois_deces"])


@_query("ordered_by_metric", f"WITH {core._R} SELECT annee AS annee_deces, mois AS mois_deces, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, annee, mois) AS position FROM r GROUP BY 1, 2")
def ordered_by_metric(spark: SparkSession, sf: str) -> DataFrame:
    return rows.with_position(_months(spark, sf), [F.desc("n"), "annee_deces", "mois_deces"])


@_query("first_after_sort", f"WITH {core._R} SELECT annee AS annee_deces, mois AS mois_deces, count(*) AS n FROM r GROUP BY 1, 2 ORDER BY 3, 1, 2 LIMIT 1")
def first_after_sort(spark: SparkSession, sf: str) -> DataFrame:
    return rows.first_by(_months(spark, sf), ["n", "annee_deces", "mois_deces"])


@_query("ordered_by_label_key", f"WITH {core._R}, x AS (SELECT CASE WHEN age <= 17 THEN '0-17 ans' WHEN age <= 29 THEN '18-29 ans' WHEN age <= 44 THEN '30-44 ans' ELSE '45-59 ans' END AS tranche_age, CASE WHEN age <= 17 THEN 1 WHEN age <= 29 THEN 2 WHEN age <= 44 THEN 3 ELSE 4 END AS ordre_tranche FROM r) SELECT tranche_age, ordre_tranche, count(*) AS n, row_number() OVER (ORDER BY ordre_tranche) AS position FROM x GROUP BY 1, 2")
def ordered_by_label_key(spark: SparkSession, sf: str) -> DataFrame:
    """Age bands in the order of their own column, as labels sort otherwise."""
    joined = joins.enrich(core.records(spark, sf), layers.dim_age(spark), "age_au_deces", "age", ["tranche_age", "ordre_tranche"])
    return rows.with_position(joined.groupBy("tranche_age", "ordre_tranche").agg(F.count(F.lit(1)).alias("n")), ["ordre_tranche"])


@_query("latest_rows_per_key", "SELECT o_custkey, o_orderkey, rn FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS rn FROM orders) WHERE rn <= 2")
def latest_rows_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return rows.row_numbered(_t(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).where("rn <= 2").select("o_custkey", "o_orderkey", "rn")


@_query("predicate_filter", "SELECT o_orderstatus, count(*) AS n, CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS dear FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderstatus <> 'P' GROUP BY 1")
def predicate_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = rows.where(_t(spark, sf, "orders"), "o_orderpriority LIKE '1%' AND o_orderstatus <> 'P'")
    return rows.indicators(kept, {"dear": F.col("o_totalprice") > 200000}).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("dear").alias("dear"))


@_query("fact_cardinality", "SELECT count(*) AS n_fact, count(*) AS n_source, true AS equal FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def fact_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    born = core.born_records(spark, sf)
    return quality.cardinality(gold.with_keys(born), born)


@_query("survival_is_monotone", f"WITH {core._R} SELECT DISTINCT CAST(annee * 100 + mois AS INTEGER) AS id_date, CAST(0 AS BIGINT) AS n_rises FROM r")
def survival_is_monotone(spark: SparkSession, sf: str) -> DataFrame:
    return windows.is_monotone(core.age_month_metrics(spark, sf), ["id_date"], ["age"], "indice_survie")


_GEN = "CASE WHEN y <= 1927 THEN 'Greatest Generation' WHEN y <= 1945 THEN 'Silent Generation' WHEN y <= 1964 THEN 'Baby Boomers' WHEN y <= 1980 THEN 'Gen X' WHEN y <= 1996 THEN 'Millennials' WHEN y <= 2012 THEN 'Gen Z' WHEN y <= 2024 THEN 'Gen Alpha' ELSE 'Gen Beta' END"


@_query("generation_years", f"WITH x AS (SELECT DISTINCT CAST(1901 + o_orderkey % 139 AS INTEGER) AS y FROM orders) SELECT {_GEN} AS generation, count(*) AS n, min(y) AS first_year, max(y) AS last_year FROM x GROUP BY 1")
def generation_years(spark: SparkSession, sf: str) -> DataFrame:
    """The years of each generation that occur."""
    years = _t(spark, sf, "orders").select((F.lit(1901) + F.col("o_orderkey") % 139).cast("int").alias("y")).distinct()
    dim = layers.dim_generation(spark)
    return quality.year_ranges(dim.join(years, F.col("annee_naissance") == F.col("y")), "generation", "annee_naissance")


@_query("generation_bands", f"WITH x AS (SELECT CAST(1901 + o_orderkey % 139 AS INTEGER) AS y FROM orders) SELECT {_GEN} AS generation, count(*) AS n FROM x GROUP BY 1")
def generation_bands(spark: SparkSession, sf: str) -> DataFrame:
    band = rules.rules_case((F.lit(1901) + F.col("o_orderkey") % 139).cast("int"), rules.GENERATIONS).alias("generation")
    return _t(spark, sf, "orders").groupBy(band).agg(F.count(F.lit(1)).alias("n"))


@_query("seasons", f"WITH {core._R} SELECT CASE WHEN mois IN (12, 1, 2) THEN 'Hiver' WHEN mois <= 5 THEN 'Printemps' WHEN mois <= 8 THEN 'Ete' ELSE 'Automne' END AS saison, count(*) AS n FROM (SELECT DISTINCT annee, mois FROM r) GROUP BY 1")
def seasons(spark: SparkSession, sf: str) -> DataFrame:
    return quality.distribution(gold.mart_monthly(core.monthly_metrics(spark, sf)), "saison", "saison")


@_query("numbers_from_text", "SELECT p_partkey, try_cast(CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) || '.5' END AS DOUBLE) AS value FROM part")
def numbers_from_text(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part")
    return part.select("p_partkey", text.to_number(F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))).alias("value"))


@_query("labelled_places", "SELECT s_suppkey AS k, n_name AS departement, r_name AS region, s_acctbal AS solde FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey % 4 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey % 2 = 0")
def labelled_places(spark: SparkSession, sf: str) -> DataFrame:
    """Three tables joined in a row, each row kept without a match."""
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), "s_nationkey", F.col("s_acctbal").alias("solde"))
    one = joins.enrich(s, _t(spark, sf, "nation").where("n_nationkey % 4 <> 0").withColumnRenamed("n_name", "departement"), "s_nationkey", "n_nationkey", ["departement", "n_regionkey"])
    return joins.enrich(one, _t(spark, sf, "region").where("r_regionkey % 2 = 0").withColumnRenamed("r_name", "region"), "n_regionkey", "r_regionkey", ["region"]).select("k", "departement", "region", "solde")


