"""Work over a total order that no single task holds: ranges of about equal numbers of rows.

The ends of ranges are quantiles of the values themselves, so they follow any
distribution. They come to the driver as a bounded list; rows are dealt by a binary
search on the JVM. Rows with one and the same value are always in one range.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows that one task may hold; with fewer in all there is a single range.
RANGE_ROWS = 100_000
#: Ranges at most; beyond RANGE_ROWS times this many rows the ranges grow.
MOST_RANGES = 4096


def holds_at_most(df: DataFrame, rows: int) -> bool:
    """Whether a frame has no more than so many rows; it is computed no further than that."""
    return df.limit(rows + 1).count() <= rows


def boundaries(df: DataFrame, col: str, rows: int = RANGE_ROWS, least_width: float = 0.0, pieces: int | None = None) -> list[float]:
    """Ascending inner ends of ranges of about ``rows`` rows each (or of ``pieces`` ranges) by a numeric column, at least ``least_width`` apart; none for a single range."""
    known = df.select(F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    n = pieces or min(MOST_RANGES, -(-known.count() // rows))
    if n <= 1:
        return []
    out: list[float] = []
    for end in known.approxQuantile("__v", [i / n for i in range(1, n)], 0.25 / n):
        if abs(end) != float("inf") and (not out or end > out[-1] and end - out[-1] >= least_width):
            out.append(end)
    return out


def dealt(df: DataFrame, col: str | Column, ends: Sequence[float], name: str) -> DataFrame:
    """Adds the number of the range that each value lies in, from 0: how many ends are not above it. NaN counts as above all, null gives -1."""
    value = F.col(col) if isinstance(col, str) else col
    if not ends:
        return df.withColumn(name, F.when(value.isNull(), -1).otherwise(0))
    held = df.withColumn("__v", value.cast("double"))
    cut = Bucketizer(splits=[float("-inf"), *ends, float("inf")], inputCol="__v", outputCol="__b", handleInvalid="keep").transform(held)
    return cut.withColumn(name, F.when(F.col("__v").isNull(), -1).otherwise(F.col("__b").cast("int"))).drop("__v", "__b")


Columns = Callable[[WindowSpec], Mapping[str, Column]]


def over_rows(df: DataFrame, order: str, columns: Columns, before: int = 0, after: int = 0, rows: int = RANGE_ROWS) -> DataFrame:
    """Window columns over all rows in ascending order of a number, for frames of up to ``before`` and ``after`` rows.

    Each range gets copies of the last and first rows of its neighbours, computes its
    columns alone and drops the copies. ``columns`` makes them from the window's order:
    it may set frames of rows, and use lag and lead, within these bounds. Rows with a
    null order come first, as in any ascending window. Few rows are one window.
    """
    ends = boundaries(df, order, rows)
    if not ends:
        return df.withColumns(dict(columns(Window.orderBy(order))))
    # a range must be able to serve its neighbour alone
    sizes = {r["__at"]: r["count"] for r in dealt(df, order, ends, "__at").groupBy("__at").count().collect()}
    kept, held = [], sizes.get(-1, 0)
    for i, end in enumerate(ends):
        held += sizes.get(i, 0)
        if held >= max(before, after, 1):
            kept.append(end)
            held = 0
    own = dealt(df, order, kept, "__own").withColumn("__own", F.greatest(F.col("__own"), F.lit(0)))
    up, down = Window.partitionBy("__own").orderBy(F.asc(order)), Window.partitionBy("__own").orderBy(F.desc(order))
    to_next = F.when(F.row_number().over(down) <= before, F.col("__own") + 1)
    to_last = F.when(F.row_number().over(up) <= after, F.col("__own") - 1)
    spread = own.withColumn("__to", F.array_compact(F.array("__own", to_next if before else F.lit(None), to_last if after else F.lit(None)))).withColumn("__at", F.explode("__to")).drop("__to")
    return spread.withColumns(dict(columns(Window.partitionBy("__at").orderBy(order)))).where("__at = __own").drop("__at", "__own")


def over_values(df: DataFrame, order: str, columns: Columns, before: float = 0, after: float = 0, rows: int = RANGE_ROWS) -> DataFrame:
    """Window columns over all rows in ascending order of a number, for frames of values up to ``before`` less and ``after`` more.

    Each range gets copies of the rows within reach of it; ranges are wider than the
    reach, so a row has three copies at most.
    """
    ends = boundaries(df, order, rows, least_width=float(max(before, after)))
    if not ends:
        return df.withColumns(dict(columns(Window.orderBy(order))))
    held = dealt(df, order, ends, "__own")
    held = dealt(held, F.col(order) - after, ends, "__lo")
    held = dealt(held, F.col(order) + before, ends, "__hi")
    spread = held.withColumn("__at", F.explode(F.sequence("__lo", "__hi")))
    return spread.withColumns(dict(columns(Window.partitionBy("__at").orderBy(order)))).where("__at = __own").drop("__at", "__own", "__lo", "__hi")
