"""Votes: verification tallies, adjudication winners, entropy, merges with support, preference pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Verdicts on a claim, those against it, and the statuses they lead to.
VERDICTS = ("supported", "platform_specific", "too_broad", "wrong", "duplicate")
AGAINST = ("too_broad", "wrong", "duplicate")


def verification(reviews: DataFrame, claim: str, verdict: str, votes: str | None = None) -> DataFrame:
    """Status and confidence of every claim from its reviews; ``votes``: a column with the number of valid votes (else its reviews).

    floor(n / 2) + 1 votes are a majority.  One against the claim rejects it; one for it, with nothing against it,
    verifies it, platform-specifically if any vote says so; anything else is contested.
    """
    v = F.col(verdict)
    n = F.max(votes) if votes else F.count(F.lit(1))
    tally = reviews.groupBy(claim).agg(n.cast("long").alias("n"), *[F.count_if(v == x).alias(x) for x in VERDICTS])
    against, in_favour = sum((F.col(x) for x in AGAINST[1:]), F.col(AGAINST[0])), F.col("supported") + F.col("platform_specific")
    majority = F.floor(F.col("n") / 2) + 1
    status = (
        F.when(against >= majority, "rejected")
        .when((against == 0) & (F.col("platform_specific") == 0) & (F.col("supported") >= majority), "verified")
        .when((against == 0) & (F.col("platform_specific") > 0) & (in_favour >= majority), "platform_specific")
        .otherwise("contested")
    )
    s = F.col("status")
    lead = F.when(s == "rejected", against).when(s == "verified", F.col("supported")).when(s == "platform_specific", in_favour).otherwise(F.greatest(*VERDICTS))
    found = tally.withColumn("status", status).withColumn("support_count", lead)
    return found.withColumn("confidence", F.round(F.try_divide("support_count", "n"), 6))


def adjudication(votes: DataFrame, case: str, candidate: str, vote: str, p: str) -> DataFrame:
    """Winner of every case: most first places, then the larger mean probability over all votes, then the first to come first.

    A candidate that a vote doesn't list has probability 0 there; agreement is the winner's share of all votes.
    """
    ranked = votes.withColumn("_first", F.row_number().over(W.partitionBy(case, vote).orderBy(F.col(p).desc(), candidate)) == 1)
    by = ranked.groupBy(case, candidate).agg(F.sum(p).alias("_p"), F.count_if("_first").alias("wins"), F.min(F.when(F.col("_first"), F.col(vote))).alias("_won"))
    cases = votes.groupBy(case).agg(F.count_distinct(vote).alias("votes"))
    order = W.partitionBy(case).orderBy(F.col("wins").desc(), F.col("_p").desc(), F.col("_won"), candidate)
    best = by.withColumn("_r", F.row_number().over(order)).where("_r = 1").join(cases, case)
    return best.select(case, F.col(candidate).alias("winner"), F.round(F.col("_p") / F.col("votes"), 6).alias("mean_p"), "wins", F.round(F.col("wins") / F.col("votes"), 6).alias("agreement"))


def entropy(rows: DataFrame, key: str, weight: Column) -> DataFrame:
    """Shannon entropy (bits) of each group's distribution."""
    shares = rows.select(key, weight.cast("double").alias("_w"))
    p = F.col("_w") / F.sum("_w").over(W.partitionBy(key))
    return shares.select(key, p.alias("p")).groupBy(key).agg(F.round(-F.sum(F.when(F.col("p") > 0, F.col("p") * F.log2("p")).otherwise(0.0)), 6).alias("entropy"))


def normalised_distribution(values: Column) -> Column:
    """Probabilities that add up to 1, or null where their sum is outside 0.95 to 1.05."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(total.between(0.95, 1.05), F.transform(values, lambda x: x / total))


def merged_claims(votes: DataFrame, keys: list[str], excluded: Column | None = None) -> DataFrame:
    """One claim for each key: how many votes support it, their evidence, confidence = support / votes.

    ``votes``: the keys, entity_id, vote, evidence.
    """
    n = votes.groupBy("entity_id").agg(F.count_distinct("vote").alias("_n"))
    kept = votes if excluded is None else votes.where(~excluded)
    grouped = kept.groupBy(*keys).agg(F.count_distinct("vote").alias("support"), F.array_sort(F.collect_set("evidence")).alias("evidence"))
    return grouped.join(n, "entity_id").withColumn("confidence", F.round(F.col("support") / F.col("_n"), 6)).drop("_n")


def top_rewrites(rewrites: DataFrame, existing: DataFrame, top: int = 6) -> DataFrame:
    """New phrases of an entity by support, at most ``top``, none that exists already."""
    fresh = rewrites.join(existing.select("entity_id", "phrase"), ["entity_id", "phrase"], "left_anti")
    counted = fresh.groupBy("entity_id", "phrase").agg(F.count_distinct("vote").alias("support"))
    return counted.withColumn("rank", F.row_number().over(W.partitionBy("entity_id").orderBy(F.col("support").desc(), "phrase"))).where(F.col("rank") <= top)


def greedy_queries(queries: DataFrame, per_claim: tuple[int, int] = (2, 5)) -> DataFrame:
    """Queries of an entity so that claims reach ``per_claim[0]`` first, then at most ``per_claim[1]``.

    ``queries``: (entity_id, query, confidence, claim_ids); order-dependent by nature, so one entity's
    queries (a few dozen) are walked together.
    """
    low, high = per_claim

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["confidence", "query"], ascending=[False, True]).to_dict("records")
        used: dict[int, int] = {}
        chosen: list[dict] = []
        for limit in (low, high):
            for r in rows:
                if r not in chosen and any(used.get(c, 0) < limit for c in r["claim_ids"]):
                    chosen.append(r)
                    for c in r["claim_ids"]:
                        used[c] = used.get(c, 0) + 1
        return pd.DataFrame(chosen, columns=pdf.columns)

    return queries.groupBy("entity_id").applyInPandas(walk, queries.schema)


def preference_pairs(cases: DataFrame, margin: float = 0.15) -> DataFrame:
    """(case, better, worse, margin) from a map of probabilities by candidate: the winner against each that is clearly behind."""
    entries = cases.select("case", "winner", F.explode(F.map_entries("p")).alias("e"))
    own = cases.select("case", F.col("p")[F.col("winner")].alias("_top"))
    pairs = entries.join(own, "case").where(F.col("e.key") != F.col("winner"))
    gap = F.round(F.col("_top") - F.col("e.value"), 6)
    return pairs.select("case", F.col("winner").alias("better"), F.col("e.key").alias("worse"), gap.alias("margin")).where(F.col("margin") >= margin)


def round_trip(rows: DataFrame, key: str, rank: str, top: int = 5) -> DataFrame:
    """Queries, those whose target came back, and the share of those within ``top``."""
    r = F.col(rank)
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("queries"), F.count(r).alias("found"), F.count_if(r <= top).alias("top"), F.round(F.avg(F.coalesce(r <= top, F.lit(False)).cast("int")), 6).alias("top_rate")
    )


def query_coverage(claims: DataFrame, queries: DataFrame, low: int = 2, high: int = 5) -> DataFrame:
    """Queries of each claim and whether their number is within bounds."""
    used = queries.select(F.explode("claim_ids").alias("claim_id")).groupBy("claim_id").agg(F.count(F.lit(1)).alias("queries"))
    return claims.join(used, "claim_id", "left").select("claim_id", F.coalesce("queries", F.lit(0)).alias("queries"), F.coalesce("queries", F.lit(0)).between(low, high).alias("covered"))
