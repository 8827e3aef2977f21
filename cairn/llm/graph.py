"""Connected components of a table of links, by alternating star operations.

Each round replaces links by links to the smallest neighbour ("large star" and
"small star"), which keeps the components and shortens every path; it ends when
each node is linked to the smallest node of its component only. Nothing but two
sums per round reaches the driver. The least neighbours are written before they are
joined, so that both sides of the join are plain exchanges and Spark can split the
partition of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged

#: About so many links are in a file of a round's tables, so that few links are not dealt to very many tasks.
FILE_LINKS = 50_000


def _large_star(links: DataFrame, files: int) -> tuple[DataFrame, DataFrame]:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(files), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), least


def _small_star(links: DataFrame, files: int) -> tuple[DataFrame, DataFrame]:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(down.groupBy("a").agg(F.min("b").alias("m")).coalesce(files), "least")
    moved = down.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
    return moved.select("x.a", "x.b").where("a <> b").distinct(), least


def _files(links: int) -> int:
    return max(1, -(-links // FILE_LINKS))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node with a link: the smallest node it can reach.

    ``links`` has long columns ``a, b``. Self links and repeated links do not matter,
    links with a null do not count; no links give no rows. Each round's tables are
    deleted once the next one is written.
    """
    now = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    before, files = None, _files(now.count())
    for _ in range(max_rounds):
        large, least = _large_star(now, files)
        between = staged(large.coalesce(files), "links")
        discard(now, least)
        small, least = _small_star(between, files)
        now = staged(small.coalesce(files), "links")
        discard(between, least)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, files = state, _files(state[0])
    else:
        raise RuntimeError("components did not settle")
    own = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own.unionByName(own.select(F.col("component").alias("node"), "component").distinct())
