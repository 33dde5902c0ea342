"""Connected components of a table of links, by alternating large and small stars.

Each round, every node points its larger neighbours (large star) and then its smaller ones (small star) at the
smallest node that it sees, until nothing changes. Every step is a join or an aggregation; nothing is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (a, b), a > b, distinct."""
    if large:  # every neighbour sees every other
        both = links.union(links.select("b", "a")).toDF("node", "other")
    else:
        both = links.toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least"))
    if large:  # a hub has very many neighbours: with both sides read and shuffled as they are, its rows can be split
        least = cut_lineage(least)
    seen = both.join(least, "node")
    if large:
        moved = seen.filter("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        moved = seen.select(F.col("other").alias("a"), F.col("least").alias("b")).filter("a > b").union(least.select("node", "least"))
    return moved.filter("a > b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has a link; component: the smallest node that can be reached. links: (a, b) of integers."""
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    now = cut_lineage(now)
    mark = _mark(now)
    for _ in range(rounds):
        now = cut_lineage(_star(_star(now, True), False))
        mark, before = _mark(now), mark
        if mark == before:
            out = now.toDF("node", "component")
            return out.union(out.select(F.col("component").alias("node"), "component").distinct())
    raise RuntimeError("components did not settle")


def _mark(links: DataFrame) -> tuple:
    """A fingerprint of the set of links: count and two sums of hashes."""
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.sum((h % 1_000_003).cast("long")), F.sum((F.xxhash64("b", "a") % 998_244_353).cast("long"))).first())
