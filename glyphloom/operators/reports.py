"""Reports: orphans, count mismatches, histograms, percentiles, coverage and publish gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(rows: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a partner."""
    return rows.join(others.select(*on), on, "left_anti")


def count_mismatches(expected: DataFrame, members: DataFrame, key: str, claimed: str) -> DataFrame:
    """Keys whose claimed number differs from how many members there are (null claims and no members count as 0)."""
    counted = members.groupBy(key).agg(F.count(F.lit(1)).alias("actual"))
    joined = expected.select(key, F.coalesce(F.col(claimed).cast("long"), F.lit(0)).alias("claimed")).join(counted, key, "left")
    return joined.withColumn("actual", F.coalesce("actual", F.lit(0))).where(F.col("claimed") != F.col("actual"))


def exclusive_groups(rows: DataFrame, key: str, has: Column, never: Column) -> DataFrame:
    """Groups in which ``has`` holds somewhere and ``never`` nowhere."""
    return rows.groupBy(key).agg(F.bool_or(has).alias("_h"), F.bool_or(never).alias("_n"), F.count(F.lit(1)).alias("n")).where(F.col("_h") & ~F.col("_n")).select(key, "n")


def rule_counts(rows: DataFrame, rules: Column, subject: list[str]) -> DataFrame:
    """Rows and distinct subjects for each rule of a list column."""
    return rows.select(F.explode(rules).alias("rule"), *subject).where("rule <> ''").groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*subject).alias("subjects"))


def histogram(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def status_pivot(rows: DataFrame, by: list[str], status: str, values: list[str]) -> DataFrame:
    """Counts by status as columns, 0 where there are none; ``values`` fixes them, so no extra pass looks for them."""
    counts = [F.count_if(F.col(status) == v).alias(v) for v in values]
    return rows.groupBy(*by).agg(*counts)


def as_map(counts: DataFrame, key: str, value: str) -> DataFrame:
    """A small count table as one map."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))).alias("counts"))


def floor_percentiles(rows: DataFrame, value: str, shares: list[float], buckets: int = 1024) -> DataFrame:
    """The values at index floor((n - 1) * p) of the sorted values, without sorting rows.

    Values are counted first.  Distinct values are then dealt into ``buckets`` ranges by approximate quantiles: running sums
    over the ranges, at most ``buckets`` rows, tell in which range each place lies, and only there are values put in order.
    """
    from pyspark.sql import Window as W

    counts = rows.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).where("_v is not null")
    cuts = sorted(set(counts.approxQuantile("_v", [k / buckets for k in range(1, buckets)], 0.5 / buckets)))
    bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.expr("cast(array() as array<double>)")
    placed = counts.withColumn("_b", F.size(F.filter(bounds, lambda c: c < F.col("_v"))))
    totals = placed.groupBy("_b").agg(F.sum("_n").alias("_in"))
    everything = W.partitionBy(F.lit(0))
    totals = totals.withColumns({"_before": F.sum("_in").over(everything.orderBy("_b")) - F.col("_in"), "_all": F.sum("_in").over(everything)})
    at = {f"p{round(p * 100)}": F.floor((F.col("_all") - 1) * p) for p in shares}
    wanted = F.lit(False)
    for place in at.values():
        wanted = wanted | ((F.col("_before") <= place) & (place < F.col("_before") + F.col("_in")))
    near = placed.join(F.broadcast(totals.where(wanted)), "_b")
    upto = near.withColumn("_upto", F.col("_before") + F.sum("_n").over(W.partitionBy("_b").orderBy("_v")))
    return upto.agg(*[F.min(F.when(F.col("_upto") > place, F.col("_v"))).alias(name) for name, place in at.items()])


def rate(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is nothing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def failed_gates(metrics: DataFrame, gates: list[tuple[str, Column]]) -> DataFrame:
    """One row: the names of the gates that don't hold, in order."""
    named = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in gates])
    return metrics.select(F.array_join(F.array_compact(named), ",").alias("failed"), (F.size(F.array_compact(named)) == 0).alias("publishable"))


def quality_report(sizes: dict[str, DataFrame]) -> DataFrame:
    """The row count of each of several tables, as one row."""
    parts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n") for name, t in sizes.items()]
    return reduce(DataFrame.unionByName, parts)


def confusion_matrix(rows: DataFrame, label: str, decision: str) -> DataFrame:
    return rows.groupBy(F.col(label).alias("label"), F.col(decision).alias("decision")).agg(F.count(F.lit(1)).alias("n"))


def cohort_audit(expected: DataFrame, accepted: DataFrame, family: str, key: str) -> DataFrame:
    """Expected, accepted and missing members by family."""
    joined = expected.select(family, key).join(accepted.select(key).distinct().withColumn("_ok", F.lit(True)), key, "left")
    ok = F.coalesce("_ok", F.lit(False))
    return joined.groupBy(family).agg(F.count(F.lit(1)).alias("expected"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("missing"))


def repeated_descriptions(rows: DataFrame, description: Column, signature: str) -> DataFrame:
    """Normalised descriptions that stand for more than one set of facts."""
    return rows.groupBy(description.alias("description")).agg(F.count_distinct(signature).alias("signatures")).where("signatures > 1")


def capacity(calls: int, minutes: float, tokens: int, entities: int, calls_per_entity: int = 2) -> dict[str, float]:
    """Throughput of a run and what it means for the rest: plain arithmetic on planner inputs."""
    import math

    per_minute = calls / minutes if minutes else 0.0
    needed = entities * calls_per_entity
    return {
        "calls_per_minute": per_minute,
        "tokens_per_call": tokens / calls if calls else 0.0,
        "calls_needed": needed,
        "hours": math.ceil(needed / per_minute / 60 * 10) / 10 if per_minute else math.inf,
        "weekly_entities": math.floor(per_minute * 60 * 24 * 7 / calls_per_entity),
    }


def inspection_report(documents: DataFrame, candidates: DataFrame, hits: DataFrame, routing: DataFrame, sites: DataFrame) -> DataFrame:
    """One row on a whole run: sizes, comment-only threads, the five warnings, and the status that follows.

    ``documents``: site, kind, id, qid, post_id, type, accepted, answers, comments; ``candidates``: site, qid; ``hits``: site,
    kind, id, post_id; ``routing``: site, id, qid; ``sites``: site, complete.  Every part is one row before they meet.
    """
    n = lambda rows, name: rows.agg(F.count(F.lit(1)).alias(name))
    posts, key = documents.where("kind = 'post'"), ["site", "_id"]
    asked = posts.select("site", F.col("id").alias("qid"))
    routed = hits.join(routing.select("site", F.col("id").alias("post_id"), "qid"), ["site", "post_id"])
    alone = exclusive_groups(routed.join(candidates, ["site", "qid"], "left_semi").withColumn("_t", F.struct("site", "qid")), "_t", F.col("kind") == "comment", F.col("kind") != "comment")
    questions = posts.where("type = 1")
    accepted = questions.where("accepted is not null").select("site", F.col("accepted").alias("_id"))

    def mismatches(claims: DataFrame, claimed: str, members: DataFrame) -> DataFrame:
        counted = members.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        own = claims.where(F.col(claimed).isNotNull()).select("site", F.col("id").alias("_id"), F.col(claimed).alias("_c"))
        return own.join(counted, key, "left").where(F.col("_c") != F.coalesce("_n", F.lit(0)))

    comments = documents.where("kind = 'comment'").select("site", F.col("post_id").alias("_id"))
    answers = posts.where("id <> qid").select("site", F.col("qid").alias("_id"))
    warnings = {
        "missing_questions": orphans(candidates, asked, ["site", "qid"]),
        "orphan_discovery_hits": orphans(hits, routing.select("site", F.col("id").alias("post_id")), ["site", "post_id"]),
        "missing_accepted_answers": orphans(accepted, posts.select("site", F.col("id").alias("_id")), key),
        "comment_count_mismatches": mismatches(posts, "comments", comments),
        "answer_count_mismatches": mismatches(questions, "answers", answers),
    }
    parts = {"candidates": candidates, "documents": documents, "discovery_hits": hits, "comment_only_threads": alone, **warnings}
    out = sites.agg(F.coalesce(F.bool_and("complete"), F.lit(False)).alias("_complete"))
    for name, rows in parts.items():
        out = out.join(F.broadcast(n(rows, name)))  # one row each
    warned = F.lit(False)
    for name in warnings:
        warned = warned | (F.col(name) > 0)
    status = F.when(~F.col("_complete"), "incomplete").when(warned, "complete_with_warnings").otherwise("complete")
    return out.select(status.alias("status"), *parts)
