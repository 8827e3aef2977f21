"""Operators that split whole groups and orders, and tables that deliveries change, against plain versions."""

import itertools
import os
from statistics import quantiles

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import line

from cairn.functions.curves import z_key
from cairn.llm.common import staged
from cairn.operators import aggregates, joins, partitions, quality, ranges, rows, sketches, windows
from cairn.plans import gold, incremental, layer_queries, measures
from cairn.sources import scratch, sinks
from cairn.streaming import ingest


def files(path):
    return {os.path.join(d, f)[len(path) :] for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# merges by partition
def test_merge_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(i, f"v{i}", y) for i, y in enumerate([2020, 2021, 2022, 2023, None] * 4)], "k int, v string, y int")
    sinks.write_table(base, path, partition_by=["y"])
    before = files(path)
    source = spark.createDataFrame([(0, "new", 2020), (5, "v5", 2020), (100, "x", 2021), (101, "n", None), (4, "v4", None), (102, "first", 2030)], "k int, v string, y int")
    counts = {r.y: (r.inserted, r.updated, r.ignored, r.rewritten) for r in partitions.merge_partitions(spark, path, source, ["k"], ["y"], how="upsert").collect()}
    assert counts == {2020: (0, 1, 1, True), 2021: (1, 0, 0, False), None: (1, 0, 1, False), 2030: (1, 0, 0, False)}
    after = files(path)
    untouched = lambda names, y: {f for f in names if f"/y={y}/" in f}
    for y in ("2022", "2023"):
        assert untouched(before, y) == untouched(after, y) != set()
    for y in ("2021", "__HIVE_DEFAULT_PARTITION__"):  # only appended to
        assert untouched(before, y) < untouched(after, y)
    assert not untouched(before, "2020") & untouched(after, "2020")
    held = spark.read.schema("k int, v string, y int").parquet(path)
    want = [(r.k, "new" if r.k == 0 else r.v, r.y) for r in base.collect()] + [(100, "x", 2021), (101, "n", None), (102, "first", 2030)]
    assert rows_of(held) == sorted(want, key=str)


def test_merge_reads_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 10).cast("int").alias("y"))
    sinks.write_table(base, path, partition_by=["y"])
    held = partitions.read_partitions(spark, path, base, ["y"], [(3,), (7,)])
    assert sorted(r[0].split("/y=")[1].split("/")[0] for r in held.select("_metadata.file_path").distinct().collect()) == sorted(["3", "7"] * (len(files(path)) // 10))
    scan = plan_of(held)
    assert "PartitionFilters" in scan and held.count() == 20
    near = partitions._near(base.where("k in (13, 27)"), held, ["k"])
    assert "GreaterThanOrEqual(k,13)" in plan_of(near) and near.count() == 4
    assert partitions.read_partitions(spark, str(tmp_path / "none"), base, ["y"], [(3,)]).count() == 0
    two = base.withColumn("z", (F.col("k") % 2).cast("int"))
    sinks.write_table(two, str(tmp_path / "two"), partition_by=["y", "z"])
    assert partitions.read_partitions(spark, str(tmp_path / "two"), two, ["y", "z"], [(1, 1), (2, 0)]).agg(F.count_distinct("y", "z")).first()[0] == 2


def test_merge_leaves_nothing_but_its_counts(spark, tmp_path, monkeypatch):
    """Of a merge's own tables only the counts stay."""
    monkeypatch.setattr(scratch, "scratch_path", lambda _, tag: f"file://{tmp_path}/own/{tag}-{next(number)}")
    number = itertools.count()
    source = spark.range(500).select("id", F.lit("v").alias("v"), (F.col("id") % 3).alias("y"))
    for how in ("insert", "upsert"):
        counts = partitions.merge_partitions(spark, str(tmp_path / "t"), source, ["id"], ["y"], how)
        assert counts.agg(F.sum("inserted"), F.sum("ignored")).first() == ((500, 0) if how == "insert" else (0, 500))
    assert {p.name.rpartition("-")[0] for p in (tmp_path / "own").iterdir()} == {"merge-counts"}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    def shuffles():
        return {f for _, _, fs in os.walk(spark.conf.get("spark.local.dir")) for f in fs if f.startswith("shuffle_")}

    counts, before = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), shuffles()
    for write in (scratch.written, staged):
        write(counts, "counts")
        assert not shuffles() - before
    counts.write.parquet(str(tmp_path / "plain"))
    assert shuffles() - before
    assert spark.conf.get(scratch.CLEANUP, "false") == "false"


def test_lines_are_written_compressed(spark):
    """Files of fixed-width lines take a part of the disk that their lines have in memory."""
    path = layer_queries._written(spark, "/root/testdata/sf0.001").removeprefix("file://")
    assert all(f.endswith(".txt.gz") for f in os.listdir(path) if f.startswith("part-"))
    size = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path))
    assert 0 < size * 3 < spark.read.text(path).agg(F.sum(F.length("value"))).first()[0]


def test_merge_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    source = spark.createDataFrame([(1, None, "a", 1), (1, None, "b", 1), (None, None, "c", 1), (2, 5, "d", 2)], "k int, j int, v string, y int")
    for how, n in (("insert", 3), ("insert", 3), ("upsert", 3)):
        partitions.merge_partitions(spark, path, source, ["k", "j"], ["y"], how)
        assert spark.read.parquet(path).count() == n
    names = files(path)
    partitions.merge_partitions(spark, path, source.limit(0), ["k", "j"], ["y"])
    assert {f for f in files(path) if os.path.getsize(path + f) > 0} >= names
    assert rows_of(spark.read.parquet(path).select("k", "j", "v")) == sorted([(1, None, "a"), (None, None, "c"), (2, 5, "d")], key=str)
    with pytest.raises(ValueError):
        partitions.merge_partitions(spark, path, source, ["k"], ["y"], how="replace")


def test_incremental_ingest_and_replay(spark, tmp_path):
    src, target, cp = tmp_path / "src", str(tmp_path / "target"), str(tmp_path / "cp")
    src.mkdir()
    key, by = ["nom_prenoms", "date_naissance", "date_deces"], {"annee": F.substring("date_deces", 1, 4)}
    for i, names in enumerate((["A", "B"], ["B", "C", "C"])):
        (src / f"f{i}.txt").write_text("\n".join(line(name=n) for n in names))
        ingest.ingest_available(spark, str(src), target, cp, key, by)
    held = files(target)
    assert sorted(r[0] for r in spark.read.parquet(target).select("nom_prenoms").collect()) == ["A", "B", "C"]
    assert ingest.committed(spark, f"{cp}-batches") == {0, 1}
    ingest.ingest_available(spark, str(src), target, str(tmp_path / "again"), key, by)  # everything once more
    assert spark.read.parquet(target).count() == 3 and held <= files(target)
    # Spark has forgotten that the batches are done, the ledger has not
    for name in os.listdir(f"{cp}/commits"):
        os.remove(f"{cp}/commits/{name}")
    ingest.ingest_available(spark, str(src), target, cp, key, by)
    assert spark.read.parquet(target).count() == 3 and spark.read.parquet(f"{cp}-batches").count() == 2


# additive states
def test_states_of_deliveries_equal_one_run(spark, tmp_path):
    rng = np.random.default_rng(1)
    data = [(None if rng.random() < 0.1 else int(rng.integers(0, 110)), None if rng.random() < 0.05 else "MF"[int(rng.integers(0, 2))], 2020 + i % 3, 1 + i % 12, i % 3) for i in range(900)]
    records = spark.createDataFrame(data, "age_au_deces int, sexe string, annee_deces int, mois_deces int, d int")
    path = str(tmp_path / "states")
    for d in (0, 1, 2, 1):
        incremental.deliver(spark, path, f"d{d}", records.where(F.col("d") == d), incremental.AGES)
    states = incremental.stored(spark, path, incremental.AGES)
    assert rows_of(incremental.by_month(states)) == rows_of(gold.by_month(records))
    assert rows_of(incremental.by_age(states)) == rows_of(gold.by_age(records))
    incremental.compacted(spark, path, str(tmp_path / "base"), incremental.AGES)
    assert rows_of(incremental.by_month(incremental.stored(spark, str(tmp_path / "base"), incremental.AGES))) == rows_of(gold.by_month(records))
    assert "records" not in plan_of(incremental.by_month(states)) and states.count() < 900


# sketches
def test_sketches_are_within_bounds(spark):
    df = spark.range(300_000).select((F.col("id") % 12).alias("m"), (F.col("id") % 3).alias("y"), (F.xxhash64("id") % 1_000_000).alias("v"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("p"))
    states = sketches.quantile_states(df.unionByName(spark.createDataFrame([(99, 99, None, None)], df.schema)), ["m", "y"], "v")
    assert states.where("m = 99").count() == 0
    for q in (0.1, 0.5, 0.99):
        guess = sketches.merged_quantiles(states, ["y"]).withColumn("x", sketches.quantile(q))
        gaps = [r.gap for r in sketches.rank_gap(df, ["y"], "v", guess, "x", q).collect()]
        assert len(gaps) == 3 and max(gaps) <= sketches.RANK_ERROR
    months = sketches.distinct_states(df, ["m", "y"], "p")
    exact = {r.y: r.n for r in df.groupBy("y").agg(F.count_distinct("p").alias("n")).collect()}
    for r in sketches.merged_distinct(months, ["y"]).select("y", sketches.distinct_estimate().alias("n")).collect():
        assert abs(r.n - exact[r.y]) <= 6 * sketches.HLL_ERROR * exact[r.y]
    sets = sketches.merged_sets(sketches.set_states(df.where("y < 2").withColumn("p", F.col("p") + F.col("y") * 20_000), ["m", "y"], "p"), ["y"])
    held = [set(r[0]) for r in df.where("y < 2").groupBy("y").agg(F.collect_set(F.col("p") + F.col("y") * 20_000)).orderBy("y").select("collect_set((p + (y * 20000)))").collect()]
    both = sketches.common(sets, "y").collect()
    assert len(both) == 1 and abs(both[0].n_common - len(held[0] & held[1])) <= 6 * sketches.THETA_ERROR * len(held[0] | held[1])


# ranges
def pareto(spark, n=20_000):
    return spark.range(n).select("id", (F.col("id") % 3).alias("g"), F.floor(F.lit(10.0**9) / (1 + F.pmod(F.xxhash64("id"), F.lit(10**6)))).alias("v"))


@pytest.mark.parametrize("descending", [True, False])
def test_ranks_of_heavy_tails(spark, descending):
    df = pareto(spark).unionByName(spark.createDataFrame([(-1, None, 5), (-2, 0, None), (-3, None, None)], "id long, g long, v long"))
    for by in ([], ["g"]):
        want = windows.rank_by(df, "v", by, descending, few=True).withColumnRenamed("rang", "want")
        got = windows.rank_by(df, "v", by, descending, range_rows=500)
        both = got.join(want.select("id", "want"), "id")
        assert both.count() == df.count() and both.where("rang <> want").count() == 0


def test_ranges_are_even(spark):
    values = pareto(spark).select("v").distinct()
    ends = ranges.boundaries(values, "v", 500)
    sizes = [r["count"] for r in ranges.dealt(values, "v", ends, "at").groupBy("at").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 1000
    assert ranges.boundaries(values, "v", 10**6) == [] and ranges.boundaries(values.limit(0), "v", 1) == []


def test_ordered_windows_across_ranges(spark):
    df = spark.range(3000).select(F.when(F.col("id") > 2, F.col("id") * F.col("id") % 7919).alias("t"), "id").dropDuplicates(["t"])

    def columns(w):
        return {"m": F.sum("id").over(w.rowsBetween(-4, 2)), "p": F.lag("id", 3).over(w), "q": F.lead("id").over(w)}

    from pyspark.sql import Window

    want = df.withColumns(columns(Window.orderBy("t")))
    got = ranges.over_rows(df, "t", columns, before=4, after=2, rows=100)
    assert rows_of(got) == rows_of(want)
    assert "SinglePartition" not in plan_of(got)

    def near(w):
        return {"n": F.count("t").over(w.rangeBetween(-30, 10)), "s": F.sum("id").over(w.rangeBetween(0, 5))}

    got = ranges.over_values(df, "t", near, before=30, after=10, rows=100)
    assert rows_of(got) == rows_of(df.withColumns(near(Window.orderBy("t"))))
    assert "SinglePartition" not in plan_of(got)
    assert rows_of(ranges.over_rows(df, "t", columns, before=4, after=2)) == rows_of(want)  # one range


def test_windows_use_ranges(spark, monkeypatch):
    df = spark.range(500).select(F.col("id").alias("t"), (F.col("id") * 7 % 31).alias("n"))
    plain = [windows.moving_average(df, "n", "t", few=True), windows.calendar_moving_average(df, "n", "t", few=True), windows.neighbour_mean(df, "t", "n", few=True), windows.previous_group_gap(df, "t", "n", few=True)]
    monkeypatch.setattr(ranges.over_rows, "__defaults__", (0, 0, 50))
    monkeypatch.setattr(ranges.over_values, "__defaults__", (0, 0, 50))
    split = [windows.moving_average(df, "n", "t"), windows.calendar_moving_average(df, "n", "t"), windows.neighbour_mean(df, "t", "n"), windows.previous_group_gap(df, "t", "n")]
    for a, b in zip(plain, split, strict=True):
        assert rows_of(a) == rows_of(b) and "SinglePartition" not in plan_of(b)


# intervals
def test_interval_join_of_many_brackets(spark):
    rules = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 37 % 1_000_003).alias("lo")).withColumn("hi", F.col("lo") + F.when(F.col("k") % 5000 == 0, 400_000).otherwise(F.col("k") % 25))
    rules = rules.unionByName(spark.createDataFrame([(-1, 5, 4), (-2, None, 9), (-3, 7, None)], rules.schema))
    df = spark.range(3000).select("id", F.when(F.col("id") % 50 != 0, F.col("id") * 331).alias("v"))
    got = joins.bracket_join(df, "v", rules, "lo", "hi").groupBy("id").agg(F.count("k").alias("n"), F.sum("k").alias("s"))
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    r = np.array([(x.k, x.lo, x.hi) for x in rules.where("lo <= hi").collect()])
    for x in got.collect():
        v = None if x.id % 50 == 0 else x.id * 331
        hit = r[(r[:, 1] <= v) & (v <= r[:, 2]), 0] if v is not None else r[:0, 0]
        assert (x.n, x.s or 0) == (len(hit), hit.sum())
    few = rules.where("k between 0 and 20")
    a, b = (joins.bracket_join(df, "v", few, "lo", "hi", how, few=f) for how, f in (("inner", 1000), ("inner", 3)))
    assert rows_of(a) == rows_of(b)


def test_bracket_totals_make_no_pairs(spark):
    """Counts and sums of brackets equal those of the join, though brackets and values have more pairs than could be made; ends and nulls included."""
    rules = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 37 % 1009).alias("lo")).withColumn("hi", F.col("lo") + F.col("k") % 60 - 3)
    rules = rules.unionByName(spark.createDataFrame([(-2, None, 9), (-3, 7, None)], rules.schema))
    df = spark.range(1500).select("id", F.when(F.col("id") % 50 != 0, F.col("id") % 1200 - 20).alias("v"))
    want = joins.bracket_join(df, "v", rules, "lo", "hi").groupBy("id").agg(F.count("k").alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("total"))
    for rows in (100, 10**6):
        assert rows_of(joins.bracket_totals(df, "v", rules, "lo", "hi", "k", rows=rows).select("id", "n", "total")) == rows_of(want)
    many = spark.range(300_000).select(F.col("id").alias("k"), F.lit(0).alias("lo"), F.lit(10).alias("hi"))
    same = spark.range(300_000).select("id", (F.col("id") % 20).alias("v"))
    assert rows_of(joins.bracket_totals(same, "v", many, "lo", "hi", "k").groupBy("n", "total").count()) == [(0, 0, 135_000), (300_000, sum(range(300_000)), 165_000)]


def test_interval_join_of_days_and_fractions(spark):
    days = spark.createDataFrame([(1, "2020-01-01", "2020-01-31"), (2, "2020-01-15", "2020-12-31"), (3, "2020-02-01", "2020-02-01")], "k int, lo string, hi string").withColumns({c: F.col(c).cast("date") for c in ("lo", "hi")})
    seen = spark.createDataFrame([("2020-01-20",), ("2020-02-01",), ("2021-01-01",), (None,)], "d string").withColumn("d", F.col("d").cast("date"))
    assert rows_of(joins.bracket_join(seen, "d", days, "lo", "hi", few=1).select("k")) == rows_of(joins.bracket_join(seen, "d", days, "lo", "hi").select("k"))
    parts = spark.createDataFrame([(1, 0.1, 0.1000001), (2, -5.5, 3.25), (3, 1e12, 1e13)], "k int, lo double, hi double")
    at = spark.createDataFrame([(0.1,), (0.10000005,), (-5.5,), (3.25,), (3.26,), (5e12,), (None,)], "v double")
    assert rows_of(joins.bracket_join(at, "v", parts, "lo", "hi", few=1)) == rows_of(joins.bracket_join(at, "v", parts, "lo", "hi"))


def test_small_looks_at_bytes(spark, monkeypatch):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit(1)).alias("a"))
    assert "isBroadcast" not in str(joins.small(wide)) and "broadcast" in joins.small(wide)._jdf.queryExecution().toString()
    monkeypatch.setattr(joins, "SMALL_BYTES", 5000)
    assert "broadcast" not in joins.small(wide)._jdf.queryExecution().toString()


# reconciliation
def test_differing_keys(spark):
    a = spark.range(5000).select("id", (F.col("id") * 3).alias("v"), F.lit("x").alias("w"))
    b = a.where("id <> 17").withColumn("v", F.when(F.col("id") == 40, None).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(-5, 1, "x"), (None, 2, "x"), (99, 297, "x")], "id long, v long, w string"))
    a2 = a.unionByName(spark.createDataFrame([(None, 3, "x")], "id long, v long, w string"))
    want = [(-5, "only_right"), (17, "only_left"), (40, "different"), (99, "different"), (None, "different")]
    for fan, levels in ((4, 3), (64, 2), (1, 1)):
        assert rows_of(quality.differing_keys(a2, b, ["id"], fan=fan, levels=levels)) == sorted(want, key=str)
    assert quality.differing_keys(a, a.orderBy(F.desc("id")), ["id"]).count() == 0
    assert quality.differing_keys(a.limit(0), a.limit(0), ["id"]).count() == 0
    assert quality.differing_keys(a, b, ["id"], cols=["w"]).where("status = 'different'").select("id").collect()[0][0] == 99


# quantiles by passes
def test_exact_quantile_of_a_large_group(spark):
    big = spark.range(200_000).select(F.lit("big").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7.0).alias("v"))
    parted = spark.range(2000).select(F.lit("parted").alias("g"), F.when(F.col("id") < 1000, F.col("id")).otherwise(F.col("id") + 10**9).cast("double").alias("v"))
    odd = spark.createDataFrame([("one", 5.0), ("none", None), (None, 1.0), (None, 2.0), ("ties", 3.0), ("ties", 3.0), ("ties", 4.0)], "g string, v double")
    df = big.unionByName(parted).unionByName(odd)
    for q in (0.5, 0.9, 0.0, 1.0):
        want = {r.g: r.x for r in df.groupBy("g").agg(F.percentile("v", q).alias("x")).collect()}
        got = {r.g: r.x for r in aggregates.exact_quantile(df, ["g"], "v", q, "x", values=50, bins=16).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], rel=1e-12) if want[k] is not None else got[k] is None for k in want)
    million = spark.range(1_000_000).select(F.lit(1).alias("g"), F.xxhash64("id").cast("double").alias("v"))
    assert aggregates.exact_quantile(million, ["g"], "v", 0.5, "x").first().x == million.agg(F.median("v")).first()[0]
    assert aggregates.exact_quantile(df, [], "v", 0.5, "x", values=50).first()[0] == pytest.approx(df.agg(F.median("v")).first()[0])
    assert quantiles([1, 2, 3], n=2) == [2]


# one scan
def test_measures_from_one_scan(spark, tmp_path):
    data = [(int(a), s, g) for a, s, g in zip(range(60, 100), "MF" * 20, "ab" * 10 + "c" * 20, strict=True)]
    spark.createDataFrame(data, "age_au_deces int, sexe string, generation string").write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    names = ["esperance_residuelle", "ecart_85_national", "part_85"]
    found = measures.evaluate({"fact": fact}, {"g": (names, ["generation"]), "s": (names[:1], ["sexe"]), "all": (names, []), "f": (names, ["generation"], "sexe = 'F'"), "none": (names, ["generation"], F.col("sexe") == "X")}, "age_au_deces > 61")
    kept = [r for r in data if r[0] > 61]
    mean = lambda xs: sum(xs) / len(xs)
    for r in found["g"].collect():
        own = [a for a, _, g in kept if g == r.generation]
        assert r.esperance_residuelle == pytest.approx(mean([a for a, *_ in kept]) - mean(own), abs=0.006)
        assert r.part_85 == pytest.approx(mean([a >= 85 for a in own]), abs=1e-4)
    women = [r for r in kept if r[1] == "F"]
    for r in found["f"].collect():
        assert r.esperance_residuelle == pytest.approx(mean([a for a, *_ in women]) - mean([a for a, _, g in women if g == r.generation]), abs=0.006)
    assert found["f"].count() == len({g for *_, g in women}) and found["none"].count() == 0
    assert found["all"].first()[0] == 0 and found["s"].columns == ["sexe", "esperance_residuelle"]
    assert str(tmp_path / "f") not in plan_of(found["g"])  # the frames read the one result, not the records


def test_zordered_files_are_skipped_by_either_column(spark, tmp_path):
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b"))
    sinks.rewrite_zordered(df, str(tmp_path / "z"), ["a", "b"], 16, bits=6)
    sinks.rewrite_clustered(df, str(tmp_path / "c"), ["a", "b"], 16)
    read = lambda p, cond: spark.read.parquet(str(tmp_path / p)).where(cond).select("_metadata.file_path").distinct().count()
    assert spark.read.parquet(str(tmp_path / "z")).count() == 20_000
    for cond in ("a < 50", "b < 50", "a > 980", "b between 500 and 520"):
        assert read("z", cond) <= 8
    assert read("c", "b < 50") == 16


def test_positions_in_a_total_order(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 977).alias("v"))
    got = rows.with_position(df, [F.desc("v"), "id"])
    want = sorted(((-r.v, r.id) for r in df.collect()))
    assert [(r.v, r.id) for r in got.orderBy("position").collect()] == [(-v, i) for v, i in want]
    assert got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()[:] == (1, 5000, 5000)
    assert rows.with_position(df.limit(0), ["v"]).count() == 0


def test_z_key_interleaves(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"), F.floor(F.col("id") / 8).cast("int").alias("b"))
    for r in df.withColumn("z", z_key([F.col("a"), F.col("b")], 3)).collect():
        want = sum((r.a >> k & 1) << 2 * k + 1 | (r.b >> k & 1) << 2 * k for k in range(3))
        assert r.z == want
    with pytest.raises(ValueError):
        z_key([F.col("a")] * 9, 8)
