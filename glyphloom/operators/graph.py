"""Similarity graphs: lexical edges, neighbours by several rules, first-wins picks by visual key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Weakest edge kept, neighbours of an entity, and the fan-out beyond which a common token makes no edges.
EDGE_FLOOR, NEIGHBOURS, FAN_OUT = 0.22, 6, 350


def similarity(a: Column, b: Column, same_category: Column, distinctive: Column) -> Column:
    """Token overlap, a bonus for shared distinctive tokens and one for the same category; at most 0.95."""
    shared = F.size(F.array_intersect(a, b))
    jaccard = shared / F.size(F.array_union(a, b))
    return F.least(F.lit(0.95), 0.65 * jaccard + F.least(F.lit(0.3), 0.12 * distinctive) + F.when(same_category, 0.1).otherwise(0.0))


def lexical_edges(entities: DataFrame, tokens: str, category: str, key: str, distinctive: list[str], fan_out: int = FAN_OUT, top: int = NEIGHBOURS) -> DataFrame:
    """(entity, neighbour, strength, rank): the closest entities that share a token.

    A token on more than ``fan_out`` entities makes pairs only if it is a distinctive one, so a common word
    can't square.
    """
    own = entities.select(F.col(key).alias("id"), F.array_distinct(tokens).alias("tokens"), F.col(category).alias("category"))
    exploded = own.select("id", F.explode("tokens").alias("token"))
    frequent = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    special = F.col("token").isin(*distinctive) if distinctive else F.lit(False)
    usable = frequent.where((F.col("df") > 1) & ((F.col("df") <= fan_out) | special)).select("token")
    blocked = exploded.join(usable, "token")
    other = blocked.withColumnRenamed("id", "other")
    pairs = blocked.join(other, "token").where(F.col("id") != F.col("other")).groupBy("id", "other").agg(F.count_if(special).alias("distinctive"))
    scored = (
        pairs.join(own, "id")
        .join(own.select(F.col("id").alias("other"), F.col("tokens").alias("other_tokens"), F.col("category").alias("other_category")), "other")
        .withColumn("strength", F.round(similarity(F.col("tokens"), F.col("other_tokens"), F.col("category").eqNullSafe(F.col("other_category")), F.col("distinctive")), 6))
        .where(F.col("strength") >= EDGE_FLOOR)
    )
    return ranked(scored, ["id"], [F.col("strength").desc(), F.col("other")], top).select("id", "other", "strength", "rank")


def ranked(rows: DataFrame, keys: list[str], order: list[Column], top: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)


def both_ways(edges: DataFrame) -> DataFrame:
    """Each undirected edge seen from either end: (id, other, strength)."""
    return edges.select(F.col("left").alias("id"), F.col("right").alias("other"), "strength").unionByName(edges.select(F.col("right").alias("id"), F.col("left").alias("other"), "strength"))


def neighbours(edges: DataFrame, visual: DataFrame, top: int = NEIGHBOURS) -> DataFrame:
    """The strongest neighbours of every entity, one for each visual key and none that looks like the entity.

    ``visual``: (id, visual_key).  Deduplication comes before the limit, so no entity is short of neighbours.
    """
    seen = both_ways(edges).join(visual, "id").withColumnRenamed("visual_key", "_own")
    seen = seen.join(visual.withColumnRenamed("id", "other"), "other").where(F.col("visual_key") != F.col("_own"))
    once = seen.withColumn("_r", F.row_number().over(W.partitionBy("id", "visual_key").orderBy(F.col("strength").desc(), "other"))).where("_r = 1")
    return ranked(once, ["id"], [F.col("strength").desc(), F.col("other")], top).select("id", "other", "strength", "rank")


def nearest_in_block(rows: DataFrame, block: list[str], key: str, position: str, top: int) -> DataFrame:
    """The ``top`` rows of the same block nearest in position, ties to the smaller key.

    Each (block, position) keeps its ``top`` + 1 smallest keys.  In a block sorted by position the nearest ``top`` rows
    lie on the ``top`` nearest other positions of either side or on the row's own, so each position looks at those and
    keeps its nearest ``top`` + 1; a row takes them without itself.  Ties of any number are exact and no pairs are formed.
    """
    own = rows.select(*[F.col(c).alias(f"_b{k}") for k, c in enumerate(block)], F.col(position).alias("_at"), F.col(key).alias("id")).distinct()
    blocks = [f"_b{k}" for k in range(len(block))]
    smallest = ranked(own, [*blocks, "_at"], [F.col("id")], top + 1)
    lists = smallest.groupBy(*blocks, "_at").agg(F.collect_list("id").alias("_keys"))
    order = W.partitionBy(*blocks).orderBy("_at")
    places = [F.struct("_at", "_keys"), *[F.lead(F.struct("_at", "_keys"), k).over(order) for k in range(-top, top + 1) if k]]
    seen = lists.select(*blocks, "_at", F.filter(F.array(*places), lambda p: p.isNotNull()).alias("_places"))
    distance = lambda p: F.abs(p["_at"] - F.col("_at"))
    near = F.flatten(F.transform("_places", lambda p: F.transform(p["_keys"], lambda k: F.struct(distance(p).isNull().alias("far"), distance(p).alias("distance"), k.alias("other")))))
    nearest = seen.select(*[F.col(c).alias(f"_{c}") for c in blocks], F.col("_at").alias("__at"), F.slice(F.array_sort(near), 1, top + 1).alias("_near"))
    same = own["_at"].eqNullSafe(nearest["__at"])
    for c in blocks:
        same &= own[c].eqNullSafe(nearest[f"_{c}"])
    others = F.slice(F.filter("_near", lambda n: n["other"] != F.col("id")), 1, top)
    spread = own.join(nearest, same).select("id", F.posexplode(others).alias("_k", "_n"))
    return spread.select("id", F.col("_n.other").alias("other"), F.col("_n.distance").alias("distance"), (F.col("_k") + 1).alias("rank"))


def fallback_neighbours(rows: DataFrame, rungs: list[list[str]], key: str, position: str, top: int) -> DataFrame:
    """Neighbours by rungs of coarser and coarser blocks, nearest in position within a rung."""
    found = None
    for rung, block in enumerate(rungs):
        part = nearest_in_block(rows, block, key, position, top * (rung + 1)).withColumn("rung", F.lit(rung))
        found = part if found is None else found.unionByName(part)
    first = found.groupBy("id", "other").agg(F.min(F.struct("rung", "distance")).alias("_b")).select("id", "other", "_b.rung", "_b.distance")
    return ranked(first, ["id"], [F.col("rung"), F.col("distance"), F.col("other")], top)


def stem_neighbours(rows: DataFrame, name: str, key: str, position: str, joint: str = " WITH ", top: int = NEIGHBOURS) -> DataFrame:
    """Names of the form STEM + joint + rest next to the row that is named STEM, by distance of position."""
    at = F.instr(F.col(name), joint)
    whole = rows.select(F.col(name).alias("stem"), F.col(key).alias("id"), F.col(position).alias("_at"))
    parts = rows.where(at > 0).select(F.substring(F.col(name), F.lit(1), at - 1).alias("stem"), F.col(key).alias("other"), F.col(position).alias("_other"))
    joined = whole.join(parts, "stem").withColumn("distance", F.abs(F.col("_at") - F.col("_other")))
    return ranked(joined, ["id"], [F.col("distance"), F.col("other")], top).select("id", "other", "distance", "rank")


def range_lookup(points: DataFrame, point: str, ranges: list[tuple[int, int, str]]) -> DataFrame:
    """Which of a fixed, disjoint list of ranges a point lies in: one sorted array and a search in it, no join."""
    lows = F.array(*[F.lit(a) for a, _, _ in sorted(ranges)])
    highs = F.array(*[F.lit(b) for _, b, _ in sorted(ranges)])
    names = F.array(*[F.lit(n) for _, _, n in sorted(ranges)])
    k = F.size(F.filter(lows, lambda x: x <= F.col(point)))
    inside = (k > 0) & (F.col(point) <= F.try_element_at(highs, F.greatest(k, F.lit(1))))
    return points.withColumn("block", F.when(inside, F.try_element_at(names, F.greatest(k, F.lit(1)))))
