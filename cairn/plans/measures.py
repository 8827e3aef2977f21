"""Named indicators over any grouping and filter.

A measure is called as ``measure(name)(model, by, where)``: ``by`` are grouping columns
and ``where`` a filter, together the context in which the indicator is evaluated. The
result has the columns ``by`` and one column named like the measure (or several, where
the measure is a table). ``model`` maps table names to frames: "fact" (see
``fact_model``) and, for measures on aggregates, "by_month", "by_place", "by_cohort",
"by_age".
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions import dates, numbers, rules
from cairn.operators import aggregates, windows
from cairn.sources.scratch import written

Model = Mapping[str, DataFrame]
Measure = Callable[..., DataFrame]
MEASURES: dict[str, Measure] = {}
#: The measures that are one aggregate expression: table and expression; and those that compare it with the value of all rows.
VALUES: dict[str, tuple[str, Callable[[], Column]]] = {}
AGAINST: dict[str, tuple[str, Callable[[], Column], Callable[[Column, Column], Column]]] = {}


def measure(name: str) -> Measure:
    return MEASURES[name]


def fact_model(records: DataFrame, generations: tuple = rules.GENERATIONS) -> DataFrame:
    """Records with the columns that measures group by: month key, birth year, generation."""
    birth = F.year("date_naissance")
    return records.withColumns({"AnMois": dates.period_key("annee_deces", "mois_deces"), "annee_naissance": birth, "generation": rules.rules_case(birth, generations)})


def _rows(model: Model, table: str, where: Column | str | None) -> DataFrame:
    return model[table] if where is None else model[table].where(where)


def _register(name: str, f: Measure) -> None:
    MEASURES[name] = f


def _value(name: str, expr: Callable[[], Column], table: str = "fact") -> None:
    """An aggregate expression per group."""
    VALUES[name] = (table, expr)
    _register(name, lambda model, by=(), where=None: together(model, [name], by, where))


def _against_all(name: str, expr: Callable[[], Column], combine: Callable[[Column, Column], Column], table: str = "fact") -> None:
    """A group's value combined with the value over all rows of the filter."""
    AGAINST[name] = (table, expr, combine)
    _register(name, lambda model, by=(), where=None: together(model, [name], by, where))


def evaluate(model: Model, contexts: Mapping[str, tuple], where: Column | str | None = None) -> dict[str, DataFrame]:
    """Measures of one table in several contexts, from one scan of its rows.

    ``contexts`` maps a name to measures, the columns that they are grouped by, and
    perhaps a filter of its own. All groupings, and those of all rows of a filter where a
    measure is compared with them, are grouping sets of a single aggregation; a filter is
    one more grouping column, whether it holds. The small result is written, and each
    context's frame is read from it.
    """
    names = list(dict.fromkeys(n for own, *_ in contexts.values() for n in own))
    (table,) = {(VALUES.get(n) or AGAINST[n])[0] for n in names}
    value = {n: (VALUES.get(n) or AGAINST[n])[1] for n in names}
    rows, flag = _rows(model, table, where), {}
    for i, (context, (_, _, *own)) in enumerate(contexts.items()):
        if own:
            flag[context] = f"__where_{i}"
            rows = rows.withColumn(flag[context], F.coalesce(F.expr(own[0]) if isinstance(own[0], str) else own[0], F.lit(False)))
    sets: dict[tuple[str, ...], None] = {}
    for context, (own, by, *_) in contexts.items():
        mine = (flag[context],) if context in flag else ()
        sets[(*by, *mine)] = None
        if any(n in AGAINST for n in own):
            sets[mine] = None
    keys = list(dict.fromkeys(k for by in sets for k in by))
    aggs = [e().alias(n) for n, e in value.items()]
    done = rows.groupingSets([list(by) for by in sets], *keys).agg(*aggs, *(F.grouping(k).alias(f"__all_{k}") for k in keys)) if keys else rows.agg(*aggs)
    found = written(done, "measures")

    def of(by: Sequence[str], context: str) -> DataFrame:
        mine = flag.get(context)
        held = found.where(F.lit(True) if not keys else reduce(lambda a, b: a & b, (F.col(f"__all_{k}") == int(k not in by and k != mine) for k in keys)))
        return held.where(F.col(mine)) if mine else held

    out = {}
    for context, (own, by, *_) in contexts.items():
        against = [n for n in own if n in AGAINST]
        held = of(by, context)
        if against:
            held = held.crossJoin(F.broadcast(of((), context).select(*(F.col(n).alias(f"__{n}") for n in against))))
        out[context] = held.select(*by, *(AGAINST[n][2](F.col(n), F.col(f"__{n}")).alias(n) if n in AGAINST else F.col(n) for n in own))
    return out


def together(model: Model, names: Sequence[str], by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Several measures of one table side by side, in one aggregation; if one is compared with all rows, by ``evaluate``."""
    if any(n in AGAINST for n in names):
        return evaluate(model, {"": (names, by)}, where)[""]
    (table,) = {VALUES[n][0] for n in names}
    return _rows(model, table, where).groupBy(*by).agg(*(VALUES[n][1]().alias(n) for n in names))


AGE, SEX, N = "age_au_deces", "sexe", lambda: F.count(F.lit(1))


def _count(cond: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.count_if(cond())


def _part(part: Callable[[], Column], whole: Callable[[], Column] = N, default: float | None = None, digits: int | None = 4) -> Callable[[], Column]:
    return lambda: numbers.ratio(part(), whole(), 1, digits, default)


men, women = _count(lambda: F.col(SEX) == "M"), _count(lambda: F.col(SEX) == "F")


def _aged(lo: int, hi: int = 10_000, sex: str | None = None) -> Callable[[], Column]:
    return _count(lambda: F.col(AGE).between(lo, hi) & (F.lit(True) if sex is None else F.col(SEX) == sex))


def _mean(cond: Callable[[], Column] | None = None) -> Callable[[], Column]:
    return lambda: F.avg(AGE if cond is None else F.when(cond(), F.col(AGE)))


# M1-M3: totals and sexes
_value("total_deces", N)
_value("total_hommes", men)
_value("total_femmes", women)
_value("pct_femmes", _part(women))
_value("pct_hommes", _part(men))
_value("ratio_h_f", _part(men, women))
# M4-M6: the very old and the young
for _name, _lo, _hi in (("nb_centenaires", 100, 10_000), ("nb_supercentenaires", 110, 10_000), ("nb_100_104", 100, 104), ("nb_105_109", 105, 109), ("nb_mineurs", 0, 17), ("nb_0_1", 0, 1), ("nb_1_4", 1, 4), ("nb_5_14", 5, 14), ("nb_15_17", 15, 17)):
    _value(_name, _aged(_lo, _hi))
_value("pct_centenaires", _part(_aged(100), default=0.0))
_value("pct_100_104", _part(_aged(100, 104), _aged(100)))
_value("pct_femmes_centenaires", _part(_aged(100, sex="F"), _aged(100)))
_value("pct_hommes_centenaires", _part(_aged(100, sex="M"), _aged(100)))
_value("part_mineurs", _part(_aged(0, 17)))
_value("pct_garcons_mineurs", _part(_aged(0, 17, "M"), _aged(0, 17)))
_value("pct_nourrissons_mineurs", _part(_aged(0, 1), _aged(0, 17)))
# ages
_value("age_moyen", lambda: F.round(_mean()(), 2))
_value("age_moyen_femmes", lambda: F.round(_mean(lambda: F.col(SEX) == "F")(), 2))
_value("age_moyen_hommes", lambda: F.round(_mean(lambda: F.col(SEX) == "M")(), 2))
_value("age_moyen_centenaires", lambda: F.round(_mean(lambda: F.col(AGE) >= 100)(), 2))
_value("age_median", lambda: F.median(AGE))
_value("age_moyen_generation", lambda: F.round(_mean()(), 2))
#: The same by the letter of the source, which averages the year of death.
_value("age_moyen_generation_litteral", lambda: F.round(F.avg("annee_deces"), 2))
_value("ecart_longevite", lambda: F.round(_mean(lambda: F.col(SEX) == "F")() - _mean(lambda: F.col(SEX) == "M")(), 2))
_value("age_moyen_femmes_agg", lambda: F.round(F.avg(F.when(F.col("nb_femmes") > F.col("nb_hommes"), F.col("age_moyen_deces"))), 2), "by_cohort")
_value("age_moyen_hommes_agg", lambda: F.round(F.avg(F.when(F.col("nb_hommes") > F.col("nb_femmes"), F.col("age_moyen_deces"))), 2), "by_cohort")
_value("ecart_longevite_agg", lambda: F.round(F.avg(F.when(F.col("nb_femmes") > F.col("nb_hommes"), F.col("age_moyen_deces"))) - F.avg(F.when(F.col("nb_hommes") > F.col("nb_femmes"), F.col("age_moyen_deces"))), 2), "by_cohort")
_against_all("esperance_residuelle", _mean(), lambda own, all_: F.round(all_ - own, 2))
_against_all("ecart_age_national", _mean(), lambda own, all_: F.round(own - all_, 2))
_value("part_85", _part(_aged(85)))
_against_all("ecart_85_national", _part(_aged(85), digits=None), lambda own, all_: F.round(own - all_, 4))
_against_all("anomalie_ratio_f_h", _part(women, men, digits=None), lambda own, all_: F.round(own - all_, 4))


def _age_moyen_mensuel(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Each group's year has the mean age of all its records."""
    rows = _rows(model, "fact", where)
    year = rows.groupBy("annee_deces").agg(F.round(F.avg(AGE), 2).alias("age_moyen_mensuel"))
    return rows.select("annee_deces", *(c for c in by if c != "annee_deces")).distinct().join(year, "annee_deces")


_register("age_moyen_mensuel", _age_moyen_mensuel)
_register("age_moyen_par_generation", lambda model, by=(), where=None: aggregates.mean_of_means(_rows(model, "fact", where), by, ["generation"], AGE, "__v").select(*by, F.round("__v", 2).alias("age_moyen_par_generation")))


def _age_attendu(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Per birth year, the mean of the mean ages of the three years on each side."""
    means = _rows(model, "fact", where).groupBy("annee_naissance").agg(F.avg(AGE).alias("m")).where("annee_naissance IS NOT NULL")
    return windows.neighbour_mean(means, "annee_naissance", "m", 3, name="age_attendu", few=True).select("annee_naissance", "age_attendu")


_register("age_attendu", _age_attendu)


def _ecart_generation(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Per generation, its mean age less that of the generation before."""
    means = _rows(model, "fact", where).groupBy("generation").agg(F.avg(AGE).alias("m"), F.min("annee_naissance").alias("first"))
    return windows.previous_group_gap(means.where("first IS NOT NULL"), "first", "m", name="ecart_generation", few=True).select("generation", "ecart_generation")


_register("ecart_generation", _ecart_generation)
# volumes
_value("deces_par_an", lambda: F.round(N() / F.count_distinct("annee_deces"), 2))
_value("communes_distinctes", lambda: F.count_distinct("code_lieu_deces"))
_value("deces_mensuel", lambda: F.sum("nb_deces"), "by_month")
_register("deces_moyen_par_mois", lambda model, by=(), where=None: _rows(model, "fact", where).groupBy(*dict.fromkeys([*by, "annee_deces", "mois_deces"])).agg(N().alias("n")).groupBy(*by).agg(F.round(F.avg("n"), 2).alias("deces_moyen_par_mois")))


# periods
def _yoy(name: str, cond: Callable[[], Column] | None = None) -> None:
    """Count of the last year of the filter, of the year before, and the change in per cent."""

    def run(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
        rows = _rows(model, "fact", where)
        rows = rows if cond is None else rows.where(cond())
        held = rows.crossJoin(F.broadcast(rows.agg(F.max("annee_deces").alias("__y"))))
        now, before = (F.count_if(F.col("annee_deces") == F.col("__y") - i) for i in (0, 1))
        return held.groupBy(*by).agg(now.alias(f"{name}_n"), before.alias(f"{name}_n_1"), numbers.ratio(now - before, before, 100, 2).alias(f"{name}_pct"))

    _register(name, run)


_yoy("variation_annuelle")
_yoy("evolution_centenaires", lambda: F.col(AGE) >= 100)
_yoy("tendance_mineurs", lambda: F.col(AGE) < 18)


def _evolution_fenetre(model: Model, by: Sequence[str] = (), where: Column | str | None = None, first: int = 0, last: int = 0, least: int = 110) -> DataFrame:
    """Records of at least an age in the years first..last against the window of equal length before."""
    rows = _rows(model, "fact", where).where(F.col(AGE) >= least)
    n = last - first + 1
    now, before = F.count_if(F.col("annee_deces").between(first, last)), F.count_if(F.col("annee_deces").between(first - n, first - 1))
    return rows.groupBy(*by).agg(now.alias("now"), before.alias("before"), numbers.ratio(now - before, before, 100, 2).alias("evolution_fenetre"))


_register("evolution_fenetre", _evolution_fenetre)


def _evolution_age(model: Model, by: Sequence[str] = (), where: Column | str | None = None, least: int = 100) -> DataFrame:
    """Per year, the mean age less that of the first year."""
    means = _rows(model, "fact", where).where(F.col(AGE) >= least).groupBy("annee_deces").agg(F.avg(AGE).alias("m"))
    first = means.agg(F.min_by("m", "annee_deces").alias("f"))
    return means.crossJoin(F.broadcast(first)).select("annee_deces", F.round(F.col("m") - F.col("f"), 2).alias("evolution_age"))


_register("evolution_age", _evolution_age)
_value("variation_absolue", lambda: F.sum("variation_vs_n_1"), "by_month")
_value("variation_moyenne_pct", lambda: F.round(F.avg("variation_pct"), 2), "by_month")


def _moyenne_mobile(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Per month, the mean of the last 12 calendar months."""
    months = _rows(model, "by_month", where).withColumn("__i", F.col("annee") * 12 + F.col("mois"))
    return windows.calendar_moving_average(months, "nb_deces", "__i", name="moyenne_mobile_12m_cal", few=True).select("AnMois", "moyenne_mobile_12m_cal")


_register("moyenne_mobile_12m_cal", _moyenne_mobile)


def _baseline(model: Model, by: Sequence[str] = (), where: Column | str | None = None, years: int = 5, limit: float = 5.0) -> DataFrame:
    """Per month: the mean of the same month in the years before, the excess in per cent, whether it is an event."""
    w = Window.partitionBy("mois").orderBy("annee").rangeBetween(-years, -1)
    held = _rows(model, "by_month", where).withColumn("baseline", F.round(F.avg("nb_deces").over(w), 2))
    held = held.withColumn("surmortalite_pct", numbers.ratio(F.col("nb_deces") - F.col("baseline"), "baseline", 100, 2))
    return held.select("AnMois", "baseline", "surmortalite_pct", F.coalesce(F.col("surmortalite_pct") > limit, F.lit(False)).alias("est_evenement"))


_register("baseline", _baseline)


def _excess(model: Model, by: Sequence[str] = (), where: Column | str | None = None, year: int = 2020, month: int | None = None, years: int = 5) -> DataFrame:
    """A year (or one month of it) against the mean of the years before, in per cent."""
    at = F.lit(True) if month is None else F.col("mois_deces") == month
    now, before = F.count_if(at & (F.col("annee_deces") == year)), F.count_if(at & F.col("annee_deces").between(year - years, year - 1)) / years
    return _rows(model, "fact", where).groupBy(*by).agg(numbers.ratio(now - before, before, 100, 2).alias("surmortalite_annee"))


_register("surmortalite_annee", _excess)
_value("surmortalite_hivernale", lambda: numbers.ratio(F.count_if(F.col("mois_deces").isin(11, 12, 1, 2)) - F.count_if(F.col("mois_deces").between(6, 9)), F.count_if(F.col("mois_deces").between(6, 9)), 100, 2))
_value("deces_periode", lambda: F.sum("nb_deces"), "by_month")
# Seasons and anomalies
_value("saisonnalite_moyenne", lambda: F.round(F.avg("indice_saisonnalite"), 3), "by_month")
_value("saisonnalite_max", lambda: F.max("indice_saisonnalite"), "by_month")
_register("profil_saisonnier", lambda model, by=(), where=None: aggregates.mean_of_means(_rows(model, "by_month", where), by or ["mois"], ["annee"], "indice_saisonnalite", "__v").select(*(by or ["mois"]), F.round("__v", 3).alias("profil_saisonnier")))
_value("deces_seuil_z", lambda: F.sum(F.when(F.abs("z_score") > 2, F.col("nb_deces"))), "by_month")
_value("z_max", lambda: F.max("z_score"), "by_month")
_value("mois_anomalie", lambda: F.count_if("anomalie_flag"), "by_month")
_register("limites_controle", lambda model, by=(), where=None: windows.control_limits(_rows(model, "by_month", where), "nb_deces").select("AnMois", "nb_deces", "limite_basse", "limite_haute"))


def _group_z(name: str, column: str) -> None:
    """Each group's total as a population z-score over the groups, its class and direction."""

    def run(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
        totals = _rows(model, "fact", where).where(F.col(column).isNotNull()).groupBy(column).agg(N().alias("nb_deces"))
        z = windows.zscore_flag(totals, "nb_deces", ddof=0, z_col="z_score", flag_col=None)
        return z.withColumns({"niveau": numbers.severity("z_score"), "sens": numbers.direction("z_score")})

    _register(name, run)


_group_z("z_commune", "code_lieu_deces")
_group_z("z_cohorte", "annee_naissance")
_group_z("z_generation", "generation")
_register("communes_z", lambda model, by=(), where=None: measure("z_commune")(model, (), where).agg(F.count_if(F.abs("z_score") > 2.5).alias("communes_z")))
_value("communes_anomalie", lambda: F.count_distinct(F.when(F.col("anomalie_mortalite"), F.col("id_commune"))), "by_place")
_value("pct_communes_anomalie", _part(lambda: F.count_if("anomalie_mortalite")), "by_place")
_value("anomalies_distribution", lambda: F.count_if("anomalie_distribution"), "by_age")
_value("anomalies_generation", lambda: F.count_if("anomalie_generation"), "by_cohort")


def _total_anomalies(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    parts = [measure(n)(model) for n in ("communes_anomalie", "anomalies_distribution", "anomalies_generation")]
    row = parts[0].crossJoin(parts[1]).crossJoin(parts[2])
    return row.select((F.col("communes_anomalie") + F.col("anomalies_distribution") + F.col("anomalies_generation")).alias("total_anomalies"))


_register("total_anomalies", _total_anomalies)
# places
_value("taux_mortalite_moyen", lambda: F.round(F.avg("taux_mortalite"), 4), "by_place")
_value("densite_moyenne", lambda: F.round(F.avg("densite_deces"), 4), "by_place")
_value("vieillissement_moyen", lambda: F.round(F.avg("indice_vieillissement"), 2), "by_place")
_value("population_couverte", lambda: F.sum("population_commune"), "by_place")
_value("taux_pour_mille", lambda: numbers.ratio(F.sum("nb_deces"), F.sum("population_commune"), 1000, 4), "by_place")


def _attendus(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """The rate of all places times each place's population."""
    rows = _rows(model, "by_place", where)
    rate = rows.agg(numbers.ratio(F.sum("nb_deces"), F.sum("population_commune")).alias("__r"))
    return rows.crossJoin(F.broadcast(rate)).select("id_commune", F.round(F.col("__r") * F.col("population_commune"), 2).alias("deces_attendus"))


_register("deces_attendus", _attendus)
_register("rang_commune", lambda model, by=(), where=None: windows.rank_by(_rows(model, "fact", where).groupBy("code_lieu_deces").agg(N().alias("nb_deces")), "nb_deces", name="rang_commune"))


# generations
def _survie(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Per generation and age: deaths, running deaths, survival, share of the generation."""
    each = _rows(model, "fact", where).where(F.col(AGE).isNotNull()).groupBy("generation", AGE).agg(N().alias("nb_deces"))
    held = windows.survival_probability(each, ["generation"], AGE, "nb_deces")
    return aggregates.share(held, ["generation"], "nb_deces", 4, "mortalite_normalisee")


_register("survie_generation", _survie)
_value("centenaires_generation", lambda: F.sum("nb_centenaires"), "by_cohort")
_value("longevite_max", lambda: F.max("age_max"), "by_cohort")
_value("longevite_moyenne", lambda: F.round(F.avg("age_moyen_deces"), 2), "by_cohort")
_value("vieillissement_generation", lambda: F.round(F.avg("indice_vieillissement"), 2), "by_cohort")
_value("surmortalite_moyenne", lambda: F.round(F.avg("surmortalite"), 3), "by_cohort")
_value("periode_active", lambda: F.max("annee_deces_max") - F.min("annee_deces_min"), "by_cohort")
_value("survie_moyenne", lambda: F.round(F.avg("indice_survie"), 4), "by_age")
_register("generation_dominante", lambda model, by=(), where=None: aggregates.argmax_group(_rows(model, "fact", where), by, "generation", N(), "generation_dominante"))
_value("tendance", lambda: F.when(F.max("tendance_mortalite") >= 100, "↑").when(F.max("tendance_mortalite") <= 0, "↓").otherwise("→"), "by_cohort")
_register("mois_max", lambda model, by=(), where=None: aggregates.max_of_totals(_rows(model, "fact", where), by, ["annee_deces", "mois_deces"], name="mois_max"))


# Report tables
def _pyramide(model: Model, by: Sequence[str] = (), where: Column | str | None = None, rule: tuple = rules.AGE_BANDS["tranche_age_5_ans"]) -> DataFrame:
    """Women positive, men negative by age band."""
    band = rules.rules_case(AGE, rule)
    return _rows(model, "fact", where).groupBy(*by, band.alias("tranche")).agg(women().alias("femmes"), (-men()).alias("hommes"))


_register("pyramide", _pyramide)


def _comparaison(model: Model, by: Sequence[str] = (), where: Column | str | None = None) -> DataFrame:
    """Per place and indicator: value, value of all, gap and rank."""
    rows = _rows(model, "fact", where).where("code_lieu_deces IS NOT NULL")
    kpis = {"nb_deces": N().cast("double"), "age_moyen": F.avg(AGE), "pct_femmes": _part(women, digits=None)(), "pct_hommes": _part(men, digits=None)(), "part_mineurs": _part(_aged(0, 17), digits=None)(), "part_85": _part(_aged(85), digits=None)()}
    own = rows.groupBy("code_lieu_deces").agg(*(v.alias(k) for k, v in kpis.items()))
    all_ = rows.agg(*(v.alias(f"all_{k}") for k, v in kpis.items()))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("indicateur"), F.col(k).alias("v"), F.col(f"all_{k}").alias("a")) for k in kpis)))
    long_ = own.crossJoin(F.broadcast(all_)).select("code_lieu_deces", each.alias("x")).select("code_lieu_deces", "x.indicateur", F.round("x.v", 4).alias("valeur"), F.round("x.a", 4).alias("national"), F.round(F.col("x.v") - F.col("x.a"), 4).alias("ecart"))
    return windows.rank_by(long_, "valeur", ["indicateur"])


_register("comparaison_commune", _comparaison)


def _evenements(model: Model, by: Sequence[str] = (), where: Column | str | None = None, events: tuple = dates.EVENTS) -> DataFrame:
    """Per month, the event it belongs to."""
    return _rows(model, "by_month", where).select("AnMois", dates.event_tag("annee", "mois", events).alias("evenement"))


_register("evenement", _evenements)
