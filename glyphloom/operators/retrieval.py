"""Retrieval harness: the rank of each query's target in BM25's top results, on two versions of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphloom.functions.stemming import stems
from glyphloom.functions.text import words
from glyphloom.operators.search import B, IDF_FLOOR, K1


def _tokens(text: str, stemmed: bool):
    return stems(words(F.col(text))) if stemmed else words(F.col(text))


def top_results(docs: DataFrame, queries: DataFrame, top: int = 10, stemmed: bool = True) -> DataFrame:
    """(query_id, entity_id, rank, relevance) of the ``top`` documents with any term of a query.

    ``docs``: entity_id, text; ``queries``: query_id, query.  Queries meet documents through the postings of their own
    terms only; smaller relevance is better, ties go to the smaller entity_id.
    """
    tokens = docs.select("entity_id", _tokens("text", stemmed).alias("_t"))
    sized = tokens.select("entity_id", "_t", F.size("_t").cast("long").alias("_len"))
    facts = sized.agg(F.count(F.lit(1)).alias("n"), F.avg("_len").alias("len")).first()
    asked = queries.select("query_id", F.explode(F.array_distinct(_tokens("query", stemmed))).alias("term"))
    postings = sized.select("entity_id", "_len", F.explode("_t").alias("term")).join(asked.select("term").distinct(), "term", "left_semi")
    postings = postings.groupBy("term", "entity_id").agg(F.count(F.lit(1)).alias("tf"), F.first("_len").alias("_len"))
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((F.lit(facts["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = postings.join(frequency.select("term", F.when(idf > 0, idf).otherwise(F.lit(IDF_FLOOR)).alias("idf")), "term")
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("_len") / F.lit(float(facts["len"] or 1))))
    scored = asked.join(weighed, "term").groupBy("query_id", "entity_id").agg(F.round(-F.sum(part), 6).alias("relevance"))
    order = W.partitionBy("query_id").orderBy("relevance", "entity_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def target_ranks(docs: DataFrame, queries: DataFrame, top: int = 10, stemmed: bool = True) -> DataFrame:
    """(query_id, rank): where the target of each query (query_id, query, target) came, null if not in the top."""
    found = top_results(docs, queries, top, stemmed).select("query_id", F.col("entity_id").alias("target"), "rank")
    return queries.select("query_id", "target").join(found, ["query_id", "target"], "left").select("query_id", "rank")


def compared(baseline: DataFrame, augmented: DataFrame, queries: DataFrame, top: int = 10, stemmed: bool = True) -> DataFrame:
    """(query_id, baseline_rank, augmented_rank) on a corpus without and with added aliases."""
    a = target_ranks(baseline, queries, top, stemmed).withColumnRenamed("rank", "baseline_rank")
    return a.join(target_ranks(augmented, queries, top, stemmed).withColumnRenamed("rank", "augmented_rank"), "query_id")
