"""Keys that put rows close in several columns close in one order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def z_key(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of several ranks below 2^bits, interleaved from the highest on; a null rank counts as 0. Ranks times bits must be below 64."""
    if len(ranks) * bits > 63:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit a long")
    key = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for r in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(F.coalesce(r, F.lit(0)).cast("long"), b).bitwiseAND(F.lit(1).cast("long")))
    return key
