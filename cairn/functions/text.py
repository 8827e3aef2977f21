"""Text cleaning functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trimmed and upper-cased (F1)."""
    return F.upper(F.trim(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    """Empty strings become null (F2)."""
    return F.nullif(_col(c), F.lit(""))


def strip_trailing(c: Column | str, mark: str = "/") -> Column:
    """Without one trailing mark; blanks before it stay."""
    c = _col(c)
    return F.when(c.endswith(mark), F.substring(c, F.lit(1), F.length(c) - len(mark))).otherwise(c)


def map_codes(c: Column | str, codes: dict[str, str]) -> Column:
    """A code's label, null for unknown codes."""
    c = _col(c)
    return reduce(lambda w, kv: w.when(c == kv[0], F.lit(kv[1])), list(codes.items())[1:], F.when(c == next(iter(codes)), F.lit(next(iter(codes.values())))))


def zfill(c: Column | str, width: int = 5) -> Column:
    """Left-padded with zeros, cut at ``width``; null and empty stay null."""
    c = _col(c).cast("string")
    return F.when(c.isNotNull() & (c != ""), F.lpad(c, width, "0"))


def split_first(c: Column | str, mark: str = "*") -> tuple[Column, Column]:
    """The trimmed parts before and after the first mark; without one the whole and "" (F6)."""
    c = _col(c)
    at = F.locate(mark, c)
    before = F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)
    after = F.when(at > 0, F.substring(c, at + len(mark), F.length(c))).when(c.isNotNull(), F.lit(""))
    return F.trim(before), F.trim(after)


def region_prefix(c: Column | str, long_prefixes: tuple[str, ...] = ("97", "98")) -> Column:
    """The first two characters of a code, three for overseas prefixes."""
    c = _col(c)
    return F.when(F.substring(c, 1, 2).isin(*long_prefixes), F.substring(c, 1, 3)).otherwise(F.substring(c, 1, 2))


def first_non_null(*columns: Column | str) -> Column:
    """The first value that is not null."""
    return F.coalesce(*(_col(c) for c in columns))


def to_number(c: Column | str, kind: str = "double") -> Column:
    """A number, or null where the text is none."""
    return F.expr("null").cast(kind) if c is None else _col(c).try_cast(kind)
