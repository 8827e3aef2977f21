"""Numeric functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def round_half_up(c: Column | str, digits: int = 0) -> Column:
    return F.round(_col(c), digits)


def ratio(num: Column | str, den: Column | str, scale: float = 1.0, digits: int | None = None, default: float | None = None) -> Column:
    """scale * num / den, rounded; ``default`` where the denominator is 0 or null."""
    den = _col(den).cast("double")
    value = F.when(den != 0, _col(num).cast("double") * scale / den)
    value = value if digits is None else F.round(value, digits)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def rate_per(count: Column | str, base: Column | str, per: float = 1000.0, digits: int = 4, least: float = 0.0) -> Column:
    """per * count / base where base is positive and at least ``least``, else null."""
    base = _col(base).cast("double")
    return F.when((base >= least) & (base > 0), F.round(_col(count).cast("double") / base * per, digits))


def density(count: Column | str, area: Column | str, digits: int = 1) -> Column:
    return rate_per(count, area, 1.0, digits)


def band_label(c: Column | str, width: int = 10) -> Column:
    """"70-79" for 72."""
    lo = (F.floor(_col(c) / width) * width).cast("int")
    return F.concat(lo.cast("string"), F.lit("-"), (lo + width - 1).cast("string"))


def stddev(c: Column | str, ddof: int = 1) -> Column:
    """Sample (ddof 1) or population (ddof 0) deviation; one row has no sample deviation."""
    return (F.stddev_samp if ddof else F.stddev_pop)(_col(c))


def severity(z: Column | str) -> Column:
    """The class of a z-score by its size."""
    a = F.abs(_col(z))
    return F.when(a > 3, "CRITIQUE").when(a > 2.5, "ÉLEVÉ").when(a > 2, "MODÉRÉ").when(a > 1.5, "LÉGER").otherwise("NORMAL")


def direction(z: Column | str) -> Column:
    """Above or below the mean; 0 and null count as below."""
    return F.when(_col(z) > 0, "Surmortalité").otherwise("Sous-mortalité")
