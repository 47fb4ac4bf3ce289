"""Threads: roles of their documents, flags rolled up, status and lane ladders, assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Thread statuses, first match wins.
STATUSES = ("request_with_evidence", "request_only", "evidence_only", "discussion", "historical_request", "review", "context_only", "unrelated")


def conversation_documents(conversations: DataFrame) -> DataFrame:
    """Turns as documents of a thread: the first user turn asks, later ones comment, system turns are history.

    ``post_id`` is the post that a document belongs to: history at the first turn revises the question, any other an answer.
    """
    first = F.min(F.when(F.col("role") == "user", F.col("turn"))).over(W.partitionBy("conv_id"))
    role = (
        F.when(F.col("role") == "assistant", "answer")
        .when(F.col("role") == "system", "history")
        .when(F.col("turn") == first, "question")
        .otherwise("comment")
    )
    docid = F.col("conv_id") * 1000 + F.col("turn")
    return conversations.select(F.col("conv_id").alias("qid"), docid.alias("docid"), F.when(F.col("turn") == 0, F.col("conv_id")).otherwise(docid).alias("post_id"), role.alias("role"), "text")


def flags(assessed: DataFrame) -> DataFrame:
    """The five flags of a source (role, status, routes, post_id, qid): requests and images count in questions and comments
    alone, evidence and discussion anywhere but in history, historical requests in revisions of the question itself."""
    request = F.col("status") == "character_request"
    asking, outside = F.col("role").isin("question", "comment"), F.col("role") != "history"
    return assessed.select(
        "*",
        (request & asking).alias("request"),
        (F.array_contains("routes", "needs_image") & asking).alias("image"),
        (F.array_contains("routes", "identity_evidence") & outside).alias("evidence"),
        (F.col("status").isin("character_request", "character_discussion") & outside).alias("discussion"),
        (request & ~outside & F.coalesce(F.col("post_id") == F.col("qid"), F.lit(False))).alias("historical_request"),
    )


def rollup(flagged: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each thread: flags, best score and status."""
    rolled = flagged.groupBy(*keys).agg(*[F.bool_or(c).alias(c) for c in ("request", "image", "evidence", "discussion", "historical_request")], F.max("score").alias("score"))
    return rolled.withColumn("status", thread_status())


def thread_status() -> Column:
    c = F.col
    return (
        F.when(c("request") & c("evidence"), "request_with_evidence")
        .when(c("request"), "request_only")
        .when(c("image"), "needs_image")
        .when(c("evidence"), "evidence_only")
        .when(c("discussion"), "discussion")
        .when(c("historical_request"), "historical_request")
        .when(c("score") == 3, "review")
        .when(c("score") > 0, "context_only")
        .otherwise("unrelated")
    )


def thread_lane(sources: DataFrame, keys: list[str]) -> DataFrame:
    """A thread's lane from the lanes of its sources (lane, role, of_question for revisions)."""
    lane, role = F.col("lane"), F.col("role")
    any_of = lambda c, name: F.bool_or(F.coalesce(c, F.lit(False))).alias(name)
    rolled = sources.groupBy(*keys).agg(
        any_of((lane == "identity") & role.isin("question", "comment"), "_asked"),
        any_of(lane == "semantics", "_semantics"),
        any_of((lane == "identity") & (role == "answer"), "_answered"),
        any_of((lane == "identity") & (role == "history") & F.col("of_question"), "_history"),
        any_of(lane == "context", "_context"),
    )
    ladder = (
        F.when(F.col("_asked"), "identity")
        .when(F.col("_semantics") & F.col("_answered"), "mixed")
        .when(F.col("_history"), "historical")
        .when(F.col("_answered"), "evidence_only")
        .when(F.col("_context"), "context")
        .when(F.col("_semantics"), "semantics")
        .otherwise("noise")
    )
    return rolled.select(*keys, ladder.alias("lane"))


def candidate_threads(hits: DataFrame, routing: DataFrame) -> DataFrame:
    """Hits resolved to threads by (site, post), with the best score of each thread."""
    return hits.join(routing.withColumnRenamed("id", "post_id"), ["site", "post_id"]).groupBy("site", "qid").agg(F.max("score").alias("score"))


def assembled(documents: DataFrame, hits: DataFrame, duplicates: DataFrame, keys: list[str]) -> DataFrame:
    """Whole threads: documents in reading order, their hits, and duplicate edges that touch them."""
    rung = F.when(F.col("kind") == "post", 0).when(F.col("kind") == "comment", 1).otherwise(2)
    docs = documents.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(rung.alias("rung"), "id", "kind", "raw"))).alias("documents"))
    found = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("kind", "id", "score"))).alias("hits"))
    edges = duplicates.select("site", F.col("a").alias("qid"), "a", "b").unionByName(duplicates.select("site", F.col("b").alias("qid"), "a", "b")).distinct()
    linked = edges.groupBy("site", "qid").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("duplicates"))
    return docs.join(found, keys, "left").join(linked, keys, "left")
