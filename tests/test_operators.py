"""Operators on small frames."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators import aggregates, joins, quality, rows, windows
from cairn.plans import layers, monitoring
from cairn.sources import readers, sinks
from cairn.streaming import ingest


def line(name="DUPONT*JEAN", sex="1", birth="19450310", place="1001", town="PARIS /", country="", death="20200805", at="97411", act="12"):
    return f"{name:80}{sex:1}{birth:8}{place:5}{town:30}{country:30}{death:8}{at:5}{act:9}"


def test_fixed_width_to_records(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "deces-2020.txt").write_text("\n".join([line(), line(), line(death="00000000"), "x" * 161, line(name="ÉLIE", sex="9")[:167]]), encoding="latin-1")
    bronze = layers.bronze(spark, str(folder), run_ts="2024-01-01", encoding="ISO-8859-1")
    assert bronze.count() == 4
    out = {r["nom"]: r for r in layers.normalised(layers.cleaned(bronze)).collect()}
    assert set(out) == {"DUPONT", "ÉLIE"}
    r = out["DUPONT"]
    assert (r["sexe"], r["code_lieu_naissance"], r["commune_naissance"], r["age_au_deces"], r["departement_deces"], r["pays_naissance"]) == ("M", "01001", "PARIS ", 75, "974", None)
    assert out["ÉLIE"]["sexe"] is None and r["_source_fichier"] == "deces-2020.txt"
    again = layers.bronze(spark, str(folder), bronze, run_ts="2024-01-02", encoding="ISO-8859-1")
    assert again.count() == bronze.count()


def test_sources(spark):
    titles = ["deces-2023.txt", "DECES-2024.TXT", "deces-2024m05.txt", "deces-2024t1.txt", "readme.txt", "deces-1999.txt"]
    listing = spark.createDataFrame([(t,) for t in titles], "title string")
    assert sorted(r.annee for r in readers.select_sources(listing, years=readers.YEARS["dev"]).collect()) == [2023, 2024]
    assert readers.ingest_new(listing, listing.where("title = 'readme.txt'")).count() == 5
    assert readers.safe_count(spark, "/nowhere/x") == -1
    with pytest.raises(ValueError):
        readers.assert_not_empty(listing.limit(0), "listing")


def test_dimensions(spark):
    ages = {r["age"]: r for r in layers.dim_age(spark).collect()}
    assert len(ages) == 146 and ages[17]["categorie_age"] == "Adolescent" and ages[145]["tranche_age"] == "90 ans et +" and ages[100]["centenaire_flag"]
    days = layers.dim_date(spark)
    assert days.count() == 7670
    assert days.where("date = '2021-01-01'").first()["semaine"] == 53 and days.where("date = '2020-02-01'").first()["weekend"]
    assert layers.dim_generation(spark).count() == 139


def test_place_dimension(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"code":"01001","nom":"A","codeDepartement":"01","codeRegion":"84","centre":{"coordinates":[5.0,46.0]},"surface":10.0,"population":5,"type":"c","epci":{"nom":"E"}},{"code":"01002","nom":"B","codeDepartement":"02","surface":0,"population":7}]')
    (tmp_path / "d.json").write_text('[{"code":"01","nom":"Ain"}]')
    (tmp_path / "r.json").write_text('[{"code":"84","nom":"ARA"}]')
    obs = [(2015, "4"), (2020, "100"), (2022, "x"), (1990, "9")]
    body = ",".join(f'{{"dimensions":{{"GEO":"01001","TIME_PERIOD":"{y}"}},"measures":{{"OBS_VALUE_NIVEAU":{{"value":"{v}"}}}}}}' for y, v in obs)
    (tmp_path / "o.json").write_text(f'{{"observations":[{body}]}}')
    read = lambda f, n, *a: f(spark, str(tmp_path / n), *a)
    places = layers.dim_place(read(readers.read_places_json, "p.json"), read(readers.read_code_list, "d.json", "code_departement", "departement"), read(readers.read_code_list, "r.json", "code_region", "region"), read(readers.read_observations_json, "o.json"), 2024)
    a, b = places.orderBy("id_commune").collect()
    assert (a["population_commune"], a["densite_commune"], a["latitude"], a["departement"]) == (100, 10.0, 46.0, "Ain")
    assert (b["population_commune"], b["densite_commune"], b["epci"], b["departement"]) == (7, None, None, None)


def test_merges(spark):
    t = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    s = spark.createDataFrame([(2, "b"), (3, "c"), (4, "d")], "k int, v string")
    rows_, counts = joins.merge_upsert(t, s, ["k"])
    assert sorted(map(tuple, rows_.collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert counts.first().asDict() == {"inserted": 1, "updated": 1, "deleted": 0, "ignored": 1}
    assert sorted(map(tuple, joins.merge_upsert(rows_, s, ["k"], True)[0].collect())) == [(2, "b"), (3, "c"), (4, "d")]
    new, counts = joins.merge_insert_only(t, s.unionByName(spark.createDataFrame([(4, "e"), (None, "n")], "k int, v string")), ["k"])
    assert new.count() == 5 and counts.first()["inserted"] == 2
    assert joins.merge_insert_only(new.where("k IS NOT NULL"), s, ["k"])[0].count() == 4


def test_keys_and_joins(spark):
    df = spark.createDataFrame([("A", None, "B"), ("A", "B", None), ("A", "", "B"), ("A", "x", "B")], "a string, b string, c string")
    assert [r[0] for r in df.select(rows.composite_key(["a", "b", "c"], not_blank=["b"])).collect()] == [None, None, None, "A|x|B"]
    assert {r["key"]: r["pct_present"] for r in rows.key_coverage(df, ["b", "c"]).collect()} == {"b": 75.0, "c": 75.0}
    ok, bad = rows.split_rejects(df, F.col("b") != "")
    assert (ok.count(), bad.count()) == (2, 2)
    p = spark.createDataFrame([(1, 10), (2, 20), (4, 40)], "t int, n int")
    assert {r["t"]: r["n_prior"] for r in joins.prior_period(p, [], "t", 1, "n").collect()} == {1: None, 2: 10, 4: None}


def test_windows(spark):
    df = spark.createDataFrame([("p", 1, 2), ("p", 2, 2), ("p", 3, 6), ("q", 1, 5)], "g string, age int, n int")
    out = windows.survival_index(windows.weighted_median(df, "age", "n", ["g"]), "n", ["g"], ["age"])
    assert sorted((r.g, r.age, r.weighted_median, r.indice_survie) for r in out.collect()) == [("p", 1, 3, 0.8), ("p", 2, 3, 0.6), ("p", 3, 3, 0.0), ("q", 1, 1, 0.0)]
    z = windows.zscore_flag(df, "n", ["g"], default=0.0, z_col="z")
    assert {r.z for r in z.where("g = 'q'").collect()} == {0.0}
    assert windows.zscore_flag(df.withColumn("n", F.lit(3)), "n", z_col="z").where("z IS NOT NULL OR anomalie").count() == 0
    gap = spark.createDataFrame([(1, 10), (2, 12), (4, 18)], "t int, n int")
    assert [r.variation for r in windows.period_change(gap, "n", [], ["t"], strict=True).orderBy("t").collect()] == [None, 2, None]
    assert [r.rang for r in windows.rank_by(spark.createDataFrame([(5,), (7,), (7,), (1,)], "n int"), "n").orderBy("rang").collect()] == [1, 1, 2, 3]
    assert windows.neighbour_mean(gap, "t", "n", 1).orderBy("t").first()["moyenne_voisins"] == 12.0


def test_aggregates(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 0), (None, "x", 5), ("b", "x", 2)], "k string, j string, v int")
    assert sorted((r.k or "", r.j or "", r.v) for r in aggregates.dedup(df, ["k", "j"]).collect()) == [("", "x", 5), ("a", "", 0), ("b", "x", 2)]
    assert aggregates.latest(df, ["k"], "v").where("k = 'a'").first()["v"] == 1
    assert aggregates.duplicates(df, ["k", "j"]).first()["n"] == 2
    tied = spark.createDataFrame([("u",), ("v",)], "l string")
    assert aggregates.argmax_group(tied, [], "l", F.count(F.lit(1))).first()["label"] == "u"


def test_quality(spark):
    df = spark.createDataFrame([("DUPONT", 75, date(1945, 3, 10), date(2020, 8, 5)), ("MARTIN", None, None, date(2021, 1, 1)), ("DURAND", -5, date(2030, 1, 1), date(1980, 5, 20)), (None, 200, date(1920, 6, 1), date(2021, 3, 1))], "nom string, age int, b date, d date")
    assert {r["column"]: r["null_pct"] for r in quality.compute_null_rates(df, ["nom"]).collect()} == {"nom": 25.0}
    with pytest.raises(ValueError):
        quality.compute_null_rates(df, ["none"])
    report = {r["metric"]: r["value"] for r in quality.compute_quality_report(df, {"nom": {"type": "not_null", "columns": ["nom"]}, "age": {"type": "range", "column": "age", "min": 0, "max": 145}, "d": {"type": "date_coherence", "columns": ["b", "d"]}}).collect()}
    assert (report["n_rows"], report["invalid_nom"], report["invalid_age"], report["invalid_d"], report["score"]) == (4, 1, 2, 1, 50.0)
    empty = {r["metric"]: r["value"] for r in quality.compute_quality_report(df.limit(0), {"nom": {"type": "not_null", "columns": ["nom"]}}).collect()}
    assert empty["score"] == 100.0


def test_sinks_and_monitoring(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.init_table_if_needed(spark, path, "a int") and not sinks.init_table_if_needed(spark, path, "a int")
    sinks.append_table(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    assert sinks.read_evolved(spark, path).columns == ["a", "b"]
    sinks.rewrite_clustered(spark.range(100), str(tmp_path / "c"), ["id"], 4)
    sinks.write_table(spark.range(10).withColumn("y", F.col("id") % 2), str(tmp_path / "y"), partition_by=["y"])
    assert spark.read.parquet(str(tmp_path / "y")).where("y = 1").count() == 5
    row = monitoring.run_row(spark, "r1", None, {"bronze": path, "silver": path, "fact": str(tmp_path / "none")}).first()
    assert (row["statut"], row["nb_bronze"], row["nb_fact"]) == ("partial", 1, None)
    m = monitoring.table_metrics({"t": ("silver", spark.read.parquet(path), "a"), "gone": ("gold", None, "k"), "empty": ("gold", spark.range(0), "id")}, spark, "r1", "2024-01-01 00:00:00")
    assert {r.table_name: r.statut for r in m.collect()} == {"t": "ok", "gone": "inaccessible", "empty": "vide"}
    assert monitoring.run_history(m).first()["nb_tables"] == 3


def test_named_tables(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "p"))
    sinks.register(spark, "t_registered", str(tmp_path / "p"))
    sinks.register(spark, "t_registered", str(tmp_path / "p"))
    sinks.save_managed(spark.range(3), "t_managed")
    sinks.save_managed(spark.range(4), "t_managed")
    assert (readers.read_table(spark, "t_registered").count(), readers.read_table(spark, "t_managed", ["id"]).count()) == (5, 4)


def test_init_table_raises_on_other_faults(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        sinks.init_table_if_needed(spark, str(tmp_path / "bad"), "a int")


def test_ranks_and_scores_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None), ("a", 5.0)], "g string, v double")
    assert sorted((r.g or "", r.v or 0, r.rang) for r in windows.rank_by(df, "v", ["g"], range_rows=2).collect()) == [("", 1.0, 2), ("", 3.0, 1), ("a", 0, 2), ("a", 5.0, 1), ("a", 5.0, 1)]
    assert sorted(r.rang for r in windows.rank_by(df, "v", descending=False).collect()) == [1, 2, 3, 3, 4]
    assert windows.zscore_flag(df, "v", ["g"], z_col="z").where("g IS NULL AND z IS NOT NULL").count() == 2
    many = spark.range(500).select((F.col("id") % 97).alias("v"))
    assert windows.rank_by(many, "v", range_rows=14).where("rang <> 97 - v").count() == 0


def test_jdbc(spark):
    url, driver = "jdbc:derby:memory:test;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    sinks.export_jdbc({"T1": spark.range(3)}, url, driver=driver)
    assert spark.read.format("jdbc").option("url", url).option("driver", driver).option("dbtable", "T1").load().count() == 3


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 9)), min_size=1, max_size=20, unique_by=lambda t: t[0]))
def test_survival_falls_to_zero(spark, pairs):
    df = spark.createDataFrame([(1, a, n) for a, n in pairs], "g int, age int, n int")
    out = [r.indice_survie for r in windows.survival_index(df, "n", ["g"], ["age"]).orderBy("age").collect()]
    assert out[-1] == 0 and all(x >= y for x, y in zip(out, out[1:], strict=False))
