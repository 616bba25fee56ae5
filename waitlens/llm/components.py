"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v")))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node reachable. Each
    round is written to the shared folder, in files by the edges of the round before; a hub's edges
    are split by the skew join. Steps are repeated until the edge set no longer changes. ``rows``:
    how many edges there are, where known."""
    edges, seen = cut(_clean(edges), rows), None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        edges, seen = cut(_clean(_small_star(_clean(_large_star(edges)))), now[0]), now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
