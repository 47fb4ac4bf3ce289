"""Queries over parsed sources: visible text, assessments, lanes, taxonomy, records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.functions import references, textviews
from glyphloom.operators import classify, lanes, records, taxonomy
from glyphloom.plans.base import query, table


@query()
def html_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            seen = [textviews.make_view(x, "Body", True) for x in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "text": [v.text for v in seen], "runs": [len(v.runs) for v in seen], "images": [len(v.images) for v in seen]})

    return table(spark, sf_dir, "pages").select("page_id", "html").mapInPandas(run, "page_id bigint, text string, runs bigint, images bigint")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as question bodies under one real-looking title each, so that requests, evidence and prose all occur."""
    titles = F.array(*[F.lit(t) for t in ("What is this symbol called?", "Use U+2192", "That is a long S", "Nothing of the kind", "What does * mean?")])
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.element_at(titles, (F.col("page_id") % 5 + 1).cast("int")).alias("Title"), F.col("html").alias("Body"), F.lit("question").alias("role"))


@query()
def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify.classified(_sources(spark, sf_dir))
    return found.select("page_id", "status", "decision", "score", "candidate", "routes", F.transform("signals", lambda s: s["text"]).alias("evidence"))


@query()
def select_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lanes.source_lanes(_sources(spark, sf_dir)).select("page_id", "lane", "priority", "reasons")


# no text has a label, an escape or a run of capitals that is a character's name
@query(r"""
SELECT doc_id, array_to_string(list_sort(list_transform(list_distinct(regexp_extract_all(coalesce(text, ''), '[^\s\p{Z}\x1c-\x1f\x85]')), lambda c: 'cp' || lpad(lower(hex(unicode(c))), 6, '0'))), ' ') AS glyphs, '' AS refs FROM documents""")
def index_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            both = [references.index_tokens(t or "") for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "glyphs": [b[0] for b in both], "refs": [b[1] for b in both]})

    return table(spark, sf_dir, "documents").select("doc_id", "text").mapInPandas(run, "doc_id bigint, glyphs string, refs string")


@query()
def taxonomy_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of the characters that stand in the documents."""
    points = taxonomy.resolved(taxonomy.code_points(spark))
    used = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0)))).alias("c")).distinct()
    return used.select(F.ascii("c").cast("bigint").alias("cp")).join(points, "cp").select("cp", "name", "family", "subfamily", "basis")


@query()
def taxonomy_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.coverage(taxonomy.resolved(taxonomy.code_points(spark)))


@query()
def taxonomy_subfamilies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.subfamily_coverage(taxonomy.resolved(taxonomy.code_points(spark)))


@query()
def taxonomy_name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.name_tokens(taxonomy.code_points(spark))


@query("""
SELECT event_id, props->>'k' AS k, json_type(props, '$.k') = 'UBIGINT' AS is_number FROM events""")
def json_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the objects are buried in prose and found again
    noise = F.concat(F.lit("Sure, {here: it is [1, "), F.lit("\n"), F.col("props"), F.lit(" as asked."))
    found = table(spark, sf_dir, "events").select("event_id", records.salvaged_json(noise).alias("j"))
    return found.select("event_id", F.get_json_object("j", "$.k").alias("k"), F.get_json_object("j", "$.k").rlike("^[0-9]+$").alias("is_number"))


@query("""
WITH s AS (SELECT p_partkey AS id, p_brand AS source, p_size > 40 AS identity, p_name || ';' || upper(p_name) || '|' || p_type AS terms FROM part),
t AS (SELECT id % 50 AS entity_id, source, identity, trim(unnest(string_split_regex(terms, '[;\\n|]'))) AS term FROM s),
n AS (SELECT *, trim(regexp_replace(lower(term), '[^a-z0-9]+', ' ', 'g')) AS normalized FROM t WHERE term <> '')
SELECT entity_id, normalized, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, bool_or(identity) AS identity FROM n WHERE normalized <> '' GROUP BY entity_id, normalized""")
def baseline_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphloom.operators.dedup import merged_vocabulary

    parts = table(spark, sf_dir, "part")
    terms = F.concat("p_name", F.lit(";"), F.upper("p_name"), F.lit("|"), "p_type")
    sources = parts.select((F.col("p_partkey") % 50).alias("entity_id"), F.col("p_brand").alias("source"), (F.col("p_size") > 40).alias("identity"), terms.alias("terms"), F.col("p_partkey").alias("ordinal"))
    return merged_vocabulary(sources).select("entity_id", "normalized", F.array_join("sources", ",").alias("sources"), "identity")
