"""Connected components of a graph given as an edge table, by alternating large-star and small-star rounds.

Every node ends up with the smallest id of its component.  Each round is a few joins and minimum
aggregations, so a node with many edges is pre-aggregated, never collected; the edges are written
to the shared folder between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.llm._storage import dropped, stored


def _star(edges: DataFrame, large: bool, spent: list[DataFrame]) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where(F.col("v") <= F.col("u"))
    # written, so that nothing stands between the join and its shuffles and a node with many edges can be split
    least = stored(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
    spent.append(least)
    joined = near.join(least.hint("merge"), "u")
    moved = joined.where(F.col("v") > F.col("u")) if large else joined.where(F.col("v") != F.col("m"))
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v"))


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(u, component), a scratch table, for every node of ``edges`` (u, v) that isn't the smallest of its component.

    Rounds grow with the logarithm of the longest path; beyond ``most_rounds`` it raises rather than give a part.
    """
    now = stored(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    for _ in range(most_rounds):
        spent = [now]
        larger = stored(_star(now, True, spent).distinct(), "cc")
        spent.append(larger)
        new = stored(_star(larger, False, spent).distinct(), "cc")
        dropped(*spent)
        now = new
        # done when it is a forest of stars: no node has two centres, and no centre has one of its own
        ends = now.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("centre"))
        ends = ends.unionByName(now.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("centre")))
        open_ = ends.groupBy("node").agg(F.sum("out").alias("outs"), F.max("centre").alias("centre")).where("outs > 1 or outs > 0 and centre = 1")
        if open_.isEmpty():
            return now.select("u", F.col("v").alias("component"))
    raise RuntimeError("components did not settle")
