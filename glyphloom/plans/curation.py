"""Queries over curation: dump rows, claims and queries, votes, vocabulary, records, checkpoints.

The driver's tables stand in for the operators' inputs; the SQL says what the operator must give for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.operators import claims, dedup, records, reports, selection, state, threads, votes
from glyphloom.plans.base import query, table
from glyphloom.sources import tables


def _text(column) -> object:
    return column.cast("string")


@query("""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey ELSE o_custkey END AS qid, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 2 END::INTEGER AS kind
FROM orders WHERE o_orderkey % 4 IN (0, 1)""")
def routed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers keep their thread, other post types go."""
    none = F.lit(None).cast("string")
    posts = table(spark, sf_dir, "orders").select(
        _text(F.col("o_orderkey")).alias("Id"), _text(F.col("o_orderkey") % 4 + 1).alias("PostTypeId"), _text(F.col("o_custkey")).alias("ParentId"),
        *[none.alias(c) for c in ("Title", "Body", "Tags", "AcceptedAnswerId", "AnswerCount", "CommentCount")],
    )
    return tables.routable_posts(posts).select("id", "qid", "kind")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_id % 11 IN (1, 2, 4, 5, 7, 8) GROUP BY event_type")
def text_history_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only revisions of texts."""
    history = table(spark, sf_dir, "events").withColumn("PostHistoryTypeId", _text(F.col("event_id") % 11))
    return tables.text_history(history).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey AS a, l_partkey AS b, count(*) AS n FROM lineitem WHERE l_linenumber = 3 GROUP BY ALL")
def duplicate_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of type 3."""
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("PostId"), F.col("l_partkey").alias("RelatedPostId"), _text(F.col("l_linenumber")).alias("LinkTypeId"))
    return tables.duplicate_links(links).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE '' END AS title, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS tags, CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END AS text FROM part""")
def source_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A post has title, body and tags, any other row a text."""
    part = table(spark, sf_dir, "part")
    rows = part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, "post").otherwise("comment").alias("kind"), F.col("p_name").alias("Title"), F.lit(None).cast("string").alias("Body"), F.col("p_brand").alias("Tags"), F.col("p_type").alias("Text"))
    own = rows.select("p_partkey", tables.fields(F.col("kind")).alias("f"))
    return own.select("p_partkey", F.col("f.Title").alias("title"), F.col("f.Tags").alias("tags"), F.col("f.Text").alias("text"))


@query("SELECT 's' AS site, o_custkey AS qid, max(l_linenumber)::INTEGER AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey")
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits resolved to threads, with the best score of each."""
    hits = table(spark, sf_dir, "lineitem").select(F.lit("s").alias("site"), F.col("l_orderkey").alias("post_id"), F.col("l_linenumber").alias("score"))
    routing = table(spark, sf_dir, "orders").select(F.lit("s").alias("site"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("qid"))
    return threads.candidate_threads(hits, routing).select("site", "qid", F.col("score").cast("int").alias("score"))


@query("""
SELECT doc_id::VARCHAR AS path, sha256(coalesce(text, '')) AS digest, CASE doc_id % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'same' ELSE 'changed' END AS status FROM documents""")
def pinned_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs against the digests that were pinned."""
    docs = table(spark, sf_dir, "documents").select(_text(F.col("doc_id")).alias("path"), F.coalesce("text", F.lit("")).cast("binary").alias("content"), (F.col("doc_id") % 3).alias("m"))
    pins = docs.where("m > 0").select("path", F.when(F.col("m") == 1, F.sha2("content", 256)).otherwise("0").alias("digest"))
    return tables.pinned(docs, pins)


@query("""
WITH live AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 100)
SELECT event_id, CASE WHEN event_type = 'click' AND l.user_id IS NULL THEN 'stale' WHEN event_type = 'click' THEN 'running' ELSE event_type END AS status FROM events e LEFT JOIN live l USING (user_id)""")
def recovered_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running work of owners that are gone becomes stale."""
    events = table(spark, sf_dir, "events")
    checkpoints = events.select("event_id", F.col("user_id").alias("owner"), F.when(F.col("event_type") == "click", "running").otherwise(F.col("event_type")).alias("status"))
    live = events.where("event_type = 'purchase' and value > 100").select(F.col("user_id").alias("owner"))
    return state.recovered(checkpoints, live).select("event_id", "status")


@query("""
SELECT o_orderpriority AS stage, count(*) FILTER (WHERE o_orderstatus = 'F') AS complete, count(*) FILTER (WHERE o_orderstatus = 'O') AS running, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed,
       count(*) FILTER (WHERE o_orderstatus = 'F') / 1000.0::DOUBLE AS share FROM orders GROUP BY o_orderpriority""")
def stage_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work by stage, and its share of a known number of entities."""
    status = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    return state.stage_progress(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("stage"), status.alias("status")), 1000)


@query("""
SELECT p_brand, count(*) AS queries, count(*) FILTER (WHERE p_size % 12 < 10) AS found, count(*) FILTER (WHERE p_size % 12 < 5) AS top, round(avg((p_size % 12 < 5)::INT), 6) AS top_rate FROM part GROUP BY p_brand""")
def round_trip_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries whose target came back, and those with it among the first five."""
    place = F.col("p_size") % 12
    rows = table(spark, sf_dir, "part").select("p_brand", F.when(place < 10, place + 1).alias("rank"))
    return votes.round_trip(rows, "p_brand", "rank")


@query("""
WITH u AS (SELECT l_partkey AS claim_id, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1)
SELECT p_partkey AS claim_id, coalesce(n, 0) AS queries, coalesce(n, 0) BETWEEN 2 AND 5 AS covered FROM part LEFT JOIN u ON p_partkey = claim_id""")
def query_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many queries use each claim, and whether that is two to five."""
    queries = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("claim_ids"))
    return votes.query_coverage(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("claim_id")), queries)


@query("""
SELECT user_id AS entity_id, md5(event_type) AS hash, min(event_id) AS render_id, array_to_string(list_sort(list(DISTINCT (event_id % 3)::VARCHAR)), ',') AS vendors FROM events GROUP BY 1, 2""")
def render_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One render for each look, with all who gave it."""
    renders = table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id"), F.md5(F.col("event_type").cast("binary")).alias("hash"), F.col("event_id").alias("render_id"), F.col("event_id").alias("ordinal"), _text(F.col("event_id") % 3).alias("vendor"))
    return records.unique_renders(renders).withColumn("vendors", F.array_join("vendors", ","))


_PHRASES = """
ph AS (
  SELECT p_brand AS entity_id, lower(p_name) AS phrase, p_partkey AS ordinal, CASE p_size % 3 WHEN 0 THEN 'direct' ELSE 'related' END AS relevance,
         CASE p_size % 4 WHEN 0 THEN 'name' WHEN 1 THEN 'meaning' WHEN 2 THEN 'use' ELSE 'appearance' END AS intent, CASE p_size % 5 WHEN 0 THEN 'slang' WHEN 1 THEN 'casual' ELSE 'technical' END AS register,
         p_size % 7 AS group_id FROM part)"""


def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("entity_id"),
        F.lower("p_name").alias("phrase"),
        F.col("p_partkey").alias("ordinal"),
        F.when(size % 3 == 0, "direct").otherwise("related").alias("relevance"),
        F.when(size % 4 == 0, "name").when(size % 4 == 1, "meaning").when(size % 4 == 2, "use").otherwise("appearance").alias("intent"),
        F.when(size % 5 == 0, "slang").when(size % 5 == 1, "casual").otherwise("technical").alias("register"),
        (size % 7).alias("group_id"),
    )


@query(f"""WITH {_PHRASES}
SELECT entity_id, phrase, ordinal, relevance FROM ph QUALIFY row_number() OVER (PARTITION BY entity_id, phrase ORDER BY (relevance = 'direct') DESC, ordinal) = 1""")
def vocabulary_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each phrase, direct if any is."""
    return records.vocabulary(_phrases(spark, sf_dir)).select("entity_id", "phrase", "ordinal", "relevance")


@query(f"""WITH {_PHRASES}
SELECT entity_id, count(*) FILTER (WHERE register = 'technical') AS technical, count(*) FILTER (WHERE register = 'slang') AS slang, count(*) FILTER (WHERE register = 'typo') AS typo FROM ph GROUP BY 1""")
def register_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases by register, zeros too."""
    return records.register_counts(_phrases(spark, sf_dir), ["technical", "slang", "typo"])


@query(f"""WITH {_PHRASES}
SELECT entity_id, group_id, ordinal FROM ph WHERE intent IN ('meaning', 'use') AND relevance = 'direct' QUALIFY row_number() OVER (PARTITION BY entity_id, group_id ORDER BY ordinal) = 1""")
def intent_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one direct phrase for each meaning or use."""
    return records.intent_candidates(_phrases(spark, sf_dir)).select("entity_id", "group_id", "ordinal")


@query(f"""WITH {_PHRASES}, n AS (SELECT DISTINCT p_brand AS entity_id, p_name AS name FROM part)
SELECT entity_id, name FROM n WHERE NOT EXISTS (SELECT 1 FROM ph WHERE ph.entity_id = n.entity_id AND intent = 'name' AND phrase = lower(n.name))""")
def unspelled_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that no name phrase spells."""
    own = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("entity_id")).agg(F.collect_set("p_name").alias("names"))
    return records.name_coverage(own, _phrases(spark, sf_dir)).select("entity_id", "name")


@query("SELECT doc_id, doc_id % 2 = 0 OR length(coalesce(text, '')) <= 10 OR substr(text, 11, 1) = '~' AS exact FROM documents WHERE text IS NOT NULL")
def exact_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: quotes that stand where they say they do; every other one begins with a sign that isn't there."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    quote = F.substring("text", 11, 20)
    wrong = F.when(F.length(quote) > 0, F.concat(F.lit("~"), F.substring("text", 12, 19))).otherwise(quote)
    rows = docs.select("doc_id", F.col("text").alias("raw"), F.when(F.col("doc_id") % 2 == 0, quote).otherwise(wrong).alias("quote"), F.lit(10).alias("begin"), F.lit(30).alias("end"))
    return records.relevant_citations(rows).select("doc_id", "exact")


_CLAIMS = """
c AS (
  SELECT p_partkey AS claim_id, p_brand AS entity_id, p_type AS normalized_phrase, p_size / 50.0 AS confidence, CASE p_size % 3 WHEN 0 THEN 'blind_ground' ELSE 'generate' END AS source_stage, p_size % 3 AS vendor_support,
         CASE p_size % 4 WHEN 0 THEN 'verified' WHEN 1 THEN 'proposed' WHEN 2 THEN 'rejected' ELSE 'contested' END AS status, CASE p_size % 5 WHEN 0 THEN 'v2' WHEN 1 THEN NULL ELSE 'v1' END AS verifier_version FROM part),
e AS (SELECT * FROM c WHERE source_stage <> 'blind_ground' OR vendor_support >= 2),
d AS (SELECT *, row_number() OVER (PARTITION BY entity_id, normalized_phrase ORDER BY (status IN ('verified', 'platform_specific')) DESC, confidence DESC, claim_id) > 1 AS duplicate FROM e),
a AS (
  SELECT *, CASE WHEN duplicate THEN 'reject' WHEN status = 'verified' AND coalesce(verifier_version = 'v2', FALSE) THEN 'retain' WHEN status IN ('proposed', 'contested', 'verified') THEN 'verify' ELSE 'none' END AS action FROM d)"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("claim_id"),
        F.col("p_brand").alias("entity_id"),
        F.col("p_type").alias("normalized_phrase"),
        (size / F.lit(50.0)).alias("confidence"),
        F.when(size % 3 == 0, "blind_ground").otherwise("generate").alias("source_stage"),
        (size % 3).alias("vendor_support"),
        F.when(size % 4 == 0, "verified").when(size % 4 == 1, "proposed").when(size % 4 == 2, "rejected").otherwise("contested").alias("status"),
        F.when(size % 5 == 0, "v2").when(size % 5 != 1, "v1").alias("verifier_version"),
    )
    return claims.verification_plan(rows, ["v2"], 2)


@query(f"WITH {_CLAIMS} SELECT claim_id, duplicate, action FROM a")
def verification_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What verification does with each claim."""
    return _plan(spark, sf_dir).select("claim_id", "duplicate", "action")


@query(f"""WITH {_CLAIMS}, o AS (
  SELECT entity_id, count(*) FILTER (WHERE action = 'verify') AS open, count(*) FILTER (WHERE action = 'retain') AS kept, count(*) FILTER (WHERE NOT duplicate) AS canonical FROM a GROUP BY 1)
SELECT entity_id, open, kept, CASE WHEN open > 0 THEN 'ready' WHEN kept >= greatest(1, least(3, canonical)) THEN 'passed' ELSE 'failed' END AS outcome FROM o""")
def verification_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with nothing left to verify."""
    return claims.verification_outcome(_plan(spark, sf_dir))


@query("""
SELECT o_custkey AS entity_id, bool_and(coalesce(o_custkey % 7 = o_orderkey % 7, FALSE) OR o_orderstatus = 'F') AS passed, count(*) AS votes FROM orders GROUP BY 1""")
def recovery_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recovery passes if every vote picked its target."""
    right = (F.col("o_custkey") % 7 == F.col("o_orderkey") % 7) | (F.col("o_orderstatus") == "F")
    return claims.recovery(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity_id"), F.when(right, F.col("o_custkey")).alias("picked_entity_id")))


@query("""
WITH r AS (
  SELECT p_partkey, ['left arrow', 'up arrow', 'left right arrow', 'acute accent', 'plain mark'][p_size % 5 + 1] AS name, ['points right', 'goes up', 'down and leftwards', 'grave one', 'nothing said'][p_partkey % 5 + 1] AS phrase FROM part)
SELECT p_partkey, (name = 'left arrow' AND phrase = 'points right') OR (name = 'up arrow' AND phrase = 'down and leftwards') OR (name = 'acute accent' AND phrase = 'grave one') AS contradicts FROM r""")
def contradicted_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases that point the other way."""
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    name = pick(["left arrow", "up arrow", "left right arrow", "acute accent", "plain mark"], F.col("p_size"))
    phrase = pick(["points right", "goes up", "down and leftwards", "grave one", "nothing said"], F.col("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", claims.contradicts(name, phrase).alias("contradicts"))


@query("""
WITH q AS (SELECT o_orderkey, o_custkey, list_sort(list(l_partkey) FILTER (WHERE l_linenumber = 2)) AS beat FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT o_orderkey, CASE WHEN coalesce(len(beat), 0) = 0 THEN 'skipped' ELSE 'open' END AS status FROM q""")
def skipped_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries that ask for no contrast are skipped."""
    rivals = table(spark, sf_dir, "lineitem").where("l_linenumber = 2").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_partkey").alias("must_beat"))
    none = F.array().cast("array<bigint>")
    queries = table(spark, sf_dir, "orders").select("o_orderkey").join(rivals, "o_orderkey", "left").select("o_orderkey", F.coalesce("must_beat", none).alias("must_beat"), none.alias("must_not"), F.lit("open").alias("status"))
    return claims.skipped_adjudications(queries).select("o_orderkey", "status")


@query("""
WITH j AS (SELECT l.doc_id, quality = 1 AS good, n_chars > 400 AS accepted FROM labels l JOIN documents USING (doc_id) WHERE quality IS NOT NULL)
SELECT count(*) FILTER (WHERE good) AS expected_good, count(*) FILTER (WHERE good AND NOT accepted) AS false_rejects, count(*) FILTER (WHERE NOT good) AS expected_bad, count(*) FILTER (WHERE NOT good AND accepted) AS false_accepts,
       TRUE AS complete, count(*) FILTER (WHERE good AND NOT accepted) / count(*) FILTER (WHERE good) AS false_reject_rate, count(*) FILTER (WHERE NOT good AND accepted) / count(*) FILTER (WHERE NOT good) AS false_accept_rate FROM j""")
def calibration_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """False accepts and rejects against labels."""
    case = [F.col("doc_id").alias("case_id"), F.lit("q").alias("path")]
    expected = table(spark, sf_dir, "labels").where("quality is not null").select(*case, (F.col("quality") == 1).alias("good"))
    answers = table(spark, sf_dir, "documents").select(*case, (F.col("n_chars") > 400).alias("accepted"))
    return claims.calibration(expected, answers)


@query("""
SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256('seed:' || doc_id), doc_id) <= 3""")
def sampled_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed sample without replacement of each family."""
    return claims.sampled_families(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", "seed", 3)


@query("""
WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('h:' || doc_id), doc_id::VARCHAR) AS r FROM documents)
SELECT doc_id::VARCHAR AS entity_id, source FROM r WHERE r <= 30 ORDER BY r, source LIMIT 30""")
def frozen_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A holdout drawn once, by strata in turn."""
    entities = table(spark, sf_dir, "documents").select(_text(F.col("doc_id")).alias("entity_id"), "source")
    return claims.frozen_holdout(entities, None, "source", 30, "h")


@query("""
SELECT 'customer' AS name, count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment <> 'BUILDING') AS n FROM customer
UNION ALL SELECT 'orders', count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus <> 'BUILDING') FROM orders""")
def version_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a purge of all other versions would remove."""
    own = {"customer": table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "version"), "orders": table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "version")}
    return dedup.version_purge(own, "version", ["BUILDING"])[0]


@query("""
SELECT coalesce(c.c_custkey, o.k) AS k, CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c.c_mktsegment ELSE coalesce(o.s, c.c_mktsegment) END AS status
FROM customer c FULL JOIN (SELECT o_custkey AS k, max(o_orderstatus) AS s FROM orders GROUP BY 1) o ON c.c_custkey = o.k""")
def keep_verified_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert that leaves settled statuses alone."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("status"))
    new = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderstatus").alias("status"))
    return dedup.merged(old, new, ["k"], {"status": "keep:BUILDING,MACHINERY"})


@query("""
WITH t AS (SELECT p_brand AS target_key, p_name AS term, lower(p_name) AS normalized, p_partkey AS ordinal FROM part),
o AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY target_key, normalized ORDER BY ordinal, term) = 1)
SELECT target_key, string_agg(term, '; ' ORDER BY ordinal) AS synonyms FROM o GROUP BY target_key""")
def synonym_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first spelling of each term, joined in order."""
    from glyphloom.operators.planning import synonym_backfill as backfill

    return backfill(table(spark, sf_dir, "part").select(F.col("p_brand").alias("target_key"), F.col("p_name").alias("term"), F.lower("p_name").alias("normalized"), F.col("p_partkey").alias("ordinal")))


@query("""
SELECT p_type, sum(p_size)::BIGINT AS tokens, count(*) AS calls, count(*) / 10.0::DOUBLE AS calls_per_minute, sum(p_size) / count(*)::DOUBLE AS tokens_per_call FROM part GROUP BY p_type""")
def token_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of tokens and calls, and the rates that follow."""
    part = table(spark, sf_dir, "part").groupBy("p_type").agg(F.sum("p_size").alias("tokens"), F.count(F.lit(1)).alias("calls"))
    return part.select("p_type", "tokens", "calls", (F.col("calls") / F.lit(10.0)).alias("calls_per_minute"), reports.rate(F.col("tokens"), F.col("calls")).alias("tokens_per_call"))


@query("""
WITH e AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS keys, max(n) AS most FROM e GROUP BY user_id""")
def property_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of properties as a map by key."""
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    listed = counted.groupBy("user_id").agg(F.collect_list(F.struct(F.col("event_type").alias("key"), F.array("n").alias("values"))).alias("properties"))
    facets = listed.select("user_id", records.facets(F.col("properties")).alias("f"))
    return facets.select("user_id", F.array_join(F.array_sort(F.map_keys("f")), ",").alias("keys"), F.array_max(F.transform(F.map_values("f"), lambda v: v[0])).alias("most"))


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'combining' ELSE 'standalone' END || ':' || replace(replace(lower(hex(p_partkey)) || '-fe0f', '-fe0f', ''), '-fe0e', '') AS visual FROM part""")
def visual_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How an entity looks, without presentation selectors."""
    part = table(spark, sf_dir, "part")
    mode = F.when(F.col("p_size") % 3 == 0, "combining").otherwise("standalone")
    return part.select("p_partkey", selection.visual_key(F.concat(F.hex("p_partkey"), F.lit("-FE0F")), mode).alias("visual"))
