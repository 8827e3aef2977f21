"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# Labels and months as the reference has them.
MONTHS = ("Janvier", "Fevrier", "Mars", "Avril", "Mai", "Juin", "Juillet", "Aout", "Septembre", "Octobre", "Novembre", "Decembre")
MONTHS_EN = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
DAYS_EN = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
SEASONS = {"Hiver": (12, 1, 2), "Printemps": (3, 4, 5), "Ete": (6, 7, 8), "Automne": (9, 10, 11)}
EVENTS = (
    (2020, (3, 4, 5), "COVID V1"),
    (2020, (10, 11, 12), "COVID V2"),
    (2021, (1, 2, 3), "COVID V3"),
    (2019, (7, 8), "Canicule 2019"),
    (2022, (6, 7, 8), "Canicule 2022"),
    (2017, (1, 2), "Grippe A 2017"),
)


def _pick(names: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in names)), i.cast("int"))


def approx_date(c: Column | str) -> Column:
    """A date from yyyyMMdd where month and day may be 00 (then 01); null if impossible."""
    c = _col(c)
    part = lambda at: F.when(F.substring(c, at, 2) == "00", F.lit("01")).otherwise(F.substring(c, at, 2))
    text = F.concat(F.substring(c, 1, 4), F.lit("-"), part(5), F.lit("-"), part(7))
    good = c.rlike("^[0-9]{8}$") & (F.substring(c, 1, 4) != "0000")
    return F.when(good, F.try_to_date(text, "yyyy-MM-dd"))


def approx_flag(c: Column | str) -> Column:
    """Whether month or day is 00; null stays null (F8)."""
    c = _col(c)
    return (F.substring(c, 5, 2) == "00") | (F.substring(c, 7, 2) == "00")


def age_years(birth: Column | str, death: Column | str, most: int = 145) -> Column:
    """floor(days / 365.25); null outside 0..most."""
    age = F.floor(F.date_diff(_col(death), _col(birth)) / F.lit(365.25)).cast("int")
    return F.when(age.between(0, most), age)


def year_of(c: Column | str) -> Column:
    return F.year(_col(c))


def month_of(c: Column | str) -> Column:
    return F.month(_col(c))


def period_key(year: Column | str, month: Column | str) -> Column:
    """yyyyMM as an int."""
    return (_col(year) * 100 + _col(month)).cast("int")


def season(month: Column | str) -> Column:
    month = _col(month)
    out = None
    for name, months in SEASONS.items():
        out = (F.when if out is None else out.when)(month.isin(*months), F.lit(name))
    return out


def month_labels(year: Column | str, month: Column | str) -> dict[str, Column]:
    """Quarter, quarter label, half-year, season and month name of a month."""
    year, month = _col(year), _col(month)
    quarter = F.ceil(month / 3).cast("int")
    return {
        "trimestre": quarter,
        "libelle_trimestre": F.concat(year.cast("string"), F.lit(" T"), quarter.cast("string")),
        "semestre": F.when(month <= 6, 1).otherwise(2),
        "saison": season(month),
        "libelle_mois": _pick(MONTHS, month),
    }


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """The attributes of a calendar day (F14); names do not depend on the JVM's locale."""
    d = _col(day)
    y, m = F.year(d), F.month(d)
    return {
        "id_date": (y * 10000 + m * 100 + F.dayofmonth(d)).cast("int"),
        "date": d,
        "annee": y,
        "mois": m,
        "mois_libelle": _pick(MONTHS_EN, m),
        "tri_mois": F.lpad(m.cast("string"), 2, "0"),
        "trimestre": F.quarter(d),
        "semestre": F.when(m <= 6, 1).otherwise(2),
        "semaine": F.weekofyear(d),
        "saison": season(m),
        "jour": F.dayofmonth(d),
        "jour_semaine": _pick(DAYS_EN, F.dayofweek(d)),
        "weekend": F.dayofweek(d).isin(1, 7),
        "AnMois": period_key(y, m),
    }


def event_tag(year: Column | str, month: Column | str, events: tuple = EVENTS) -> Column:
    """The name of the event that a month belongs to, else null."""
    out = None
    for y, months, name in events:
        out = (F.when if out is None else out.when)((_col(year) == y) & _col(month).isin(*months), F.lit(name))
    return out
