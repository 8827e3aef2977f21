"""Rule tables and the conditions built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

Rule = tuple[int, int, object]


def _even(width: int, top: int, last: int) -> tuple[Rule, ...]:
    """Bands of equal width below ``top`` and one from ``top`` to ``last``."""
    return (*((lo, lo + width - 1, f"{lo}-{lo + width - 1} ans") for lo in range(0, top, width)), (top, last, f"{top} ans et +"))


MAX_AGE = 145
# Age bands and generations as the reference has them.
AGE_BANDS: dict[str, tuple[Rule, ...]] = {
    "tranche_age": ((0, 17, "0-17 ans"), (18, 29, "18-29 ans"), (30, 44, "30-44 ans"), (45, 59, "45-59 ans"), (60, 74, "60-74 ans"), (75, 89, "75-89 ans"), (90, 145, "90 ans et +")),
    "tranche_age_5_ans": _even(5, 100, MAX_AGE),
    "tranche_age_10_ans": _even(10, 100, MAX_AGE),
    "categorie_age": ((0, 11, "Enfant"), (12, 17, "Adolescent"), (18, 64, "Adulte"), (65, 79, "Senior"), (80, 145, "Grand senior")),
}
BAND_ORDER = tuple((lo, hi, i) for i, (lo, hi, _) in enumerate(AGE_BANDS["tranche_age"], 1))
GENERATIONS: tuple[Rule, ...] = (
    (1901, 1927, "Greatest Generation"),
    (1928, 1945, "Silent Generation"),
    (1946, 1964, "Baby Boomers"),
    (1965, 1980, "Gen X"),
    (1981, 1996, "Millennials"),
    (1997, 2012, "Gen Z"),
    (2013, 2024, "Gen Alpha"),
    (2025, 2039, "Gen Beta"),
)


def rules_case(c: Column | str, rules: tuple[Rule, ...], default: object = "Inconnue") -> Column:
    """The result of the first rule (lo, hi, result) that holds the value, else ``default``."""
    c, out = _col(c), None
    for lo, hi, result in rules:
        out = (F.when if out is None else out.when)(c.between(lo, hi), F.lit(result))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
