"""Run and table monitoring."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.rows import latest_n
from cairn.sources.readers import safe_count, safe_read

RUNS = "run_id string, run_timestamp timestamp, pipeline string, environnement string, nb_bronze long, nb_silver long, nb_fact long, nb_anomalies_age long, nb_anomalies_temporel long, nb_anomalies_geographie long, nb_anomalies_generation long, taux_rejet_pct double, statut string, notes string"
METRICS = "run_id string, run_timestamp timestamp, couche string, table_name string, cle string, nb_lignes long, nb_colonnes long, nb_null_cle long, pct_null_cle double, statut string, notes string"


def run_row(spark: SparkSession, run_id: str, run_ts: object, refs: Mapping[str, str], flags: Mapping[str, tuple[str, str]] | None = None, pipeline: str = "gold", env: str = "dev") -> DataFrame:
    """One row on a run: counts of bronze, silver and fact, anomalies, reject rate, state.

    ``refs`` names these tables; ``flags`` maps age, temporel, geographie and generation to
    (table, flag column). Unreadable tables count as null.
    """
    n = {k: safe_count(spark, refs[k]) if k in refs else -1 for k in ("bronze", "silver", "fact")}
    odd = {k: safe_count(spark, *flags[k]) if flags and k in flags else -1 for k in ("age", "temporel", "geographie", "generation")}
    state = "success" if all(v > 0 for v in n.values()) else "failed" if all(v < 0 for v in n.values()) else "partial"
    lost = round((n["bronze"] - n["silver"]) * 100.0 / n["bronze"], 4) if n["bronze"] > 0 and n["silver"] >= 0 else None
    known = lambda v: None if v < 0 else v
    notes = "; ".join(f"{k}: missing" for k, v in n.items() if v < 0) or None
    row = (run_id, run_ts, pipeline, env, *(known(n[k]) for k in ("bronze", "silver", "fact")), *(known(v) for v in odd.values()), lost, state, notes)
    return spark.createDataFrame([row], RUNS)


def table_metrics(tables: Mapping[str, tuple[str, DataFrame | None, str]], spark: SparkSession, run_id: str, run_ts: object, limit: float = 10.0) -> DataFrame:
    """One row per table: rows, columns, nulls in its key, state and note (C17).

    ``tables`` maps a name to (layer, frame or None, key). Each table is read once.
    """
    out = None
    for name, (layer, df, key) in tables.items():
        if df is None:
            row = spark.createDataFrame([(None, None, None)], "n long, c long, k long")
        else:
            row = df.agg(F.count(F.lit(1)).alias("n"), F.lit(len(df.columns)).cast("long").alias("c"), F.count_if(F.col(key).isNull()).alias("k"))
        row = row.select(F.lit(layer).alias("couche"), F.lit(name).alias("table_name"), F.lit(key).alias("cle"), "n", "c", "k")
        out = row if out is None else out.unionByName(row)
    pct = F.when(F.col("n") > 0, F.round(F.col("k") * 100.0 / F.col("n"), 2))
    state = F.when(F.col("n").isNull(), "inaccessible").when(F.col("n") == 0, "vide").otherwise("ok")
    note = F.when(F.col("n") == 0, "table vide").when(pct > limit, F.concat(F.lit("cle nulle a "), pct.cast("string"), F.lit(" %")))
    return out.select(
        F.lit(run_id).alias("run_id"), F.lit(run_ts).cast("timestamp").alias("run_timestamp"), "couche", "table_name", "cle",
        F.col("n").alias("nb_lignes"), F.col("c").alias("nb_colonnes"), F.col("k").alias("nb_null_cle"), pct.alias("pct_null_cle"), state.alias("statut"), note.alias("notes"),
    )


def metrics_of(spark: SparkSession, catalogue: Mapping[str, tuple[str, str, str]], run_id: str, run_ts: object) -> DataFrame:
    """``table_metrics`` of tables by path or name: name -> (layer, reference, key)."""
    return table_metrics({n: (layer, safe_read(spark, ref), key) for n, (layer, ref, key) in catalogue.items()}, spark, run_id, run_ts)


def run_history(metrics: DataFrame, n: int = 10) -> DataFrame:
    """The latest runs: tables, good ones, alerts."""
    runs = metrics.groupBy("run_id").agg(F.max("run_timestamp").alias("run_timestamp"), F.count(F.lit(1)).alias("nb_tables"), F.count_if(F.col("statut") == "ok").alias("nb_ok"), F.count_if(F.col("notes").isNotNull()).alias("nb_alertes"))
    return latest_n(runs, "run_timestamp", n, ["run_id"])
