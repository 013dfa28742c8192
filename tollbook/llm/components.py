"""Connected components of links, by turns of large stars and small stars, as joins and partial minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import kept_table

MAX_TURNS = 60


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node that has a link; links has columns a and b.

    Each turn is a minimum per node, made partial before the shuffle, and a join; nothing of a group meets in one
    place. Links of a node with itself and repeated links do no harm.
    """
    edges = kept_table(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges")
    before = _state(edges)
    for _ in range(MAX_TURNS):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = kept_table(small, "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_TURNS} turns")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
