"""Queries over entity analytics: selection, graphs, votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphloom.functions import text as tx
from glyphloom.operators import claims, dedup, graph, sampling, selection, votes
from glyphloom.plans.base import query, table


@query("""
WITH s AS (
  SELECT p_partkey AS key, CASE p_size % 4 WHEN 0 THEN 'symbol' WHEN 1 THEN 'letter' WHEN 2 THEN 'number' ELSE 'other' END AS grp, p_size AS popularity, p_retailprice > 1500 AS block FROM part),
x AS (
  SELECT *, (CASE grp WHEN 'symbol' THEN 9000 WHEN 'letter' THEN 2000 WHEN 'number' THEN 7500 ELSE 0 END
    + CASE WHEN popularity > 0 THEN 20000 + floor(log2(1 + greatest(0, popularity)) * 250 + 0.5)::BIGINT ELSE 0 END
    + CASE WHEN block THEN 4000 ELSE 0 END + 150)::BIGINT AS selection_score,
    CASE WHEN popularity > 0 OR block THEN 2 ELSE 5 END AS selection_tier FROM s)
SELECT key, selection_score, selection_tier::INTEGER AS selection_tier,
  row_number() OVER (ORDER BY CASE grp WHEN 'symbol' THEN 0 WHEN 'number' THEN 1 WHEN 'letter' THEN 2 ELSE 3 END, selection_tier, selection_score DESC, key)::INTEGER AS selection_rank
FROM x ORDER BY selection_rank LIMIT 300""")
def ranked_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("p_size") % 4
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("key"),
        F.lit("part").alias("kind"),
        F.when(m == 0, "symbol").when(m == 1, "letter").when(m == 2, "number").otherwise("other").alias("group"),
        F.col("p_size").alias("popularity"),
        (F.col("p_retailprice") > 1500).alias("visual_block"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("failure_count", "int"), ("severity", "int"), ("seeded", "boolean"), ("preferred_letter", "boolean"), ("has_alias", "boolean"), ("is_sequence", "boolean"))],
    )
    order = selection.selection_order(["symbol", "number", "letter"])
    out = selection.selected(selection.scored(parts), order, 300)
    return out.select(F.col("key").cast("long").alias("key"), "selection_score", "selection_tier", "selection_rank")


_NAMES = "n AS (SELECT p_name AS name, min(p_partkey) AS id, min(p_type) AS category FROM part GROUP BY p_name)"


@query(f"""
WITH {_NAMES}, t AS (SELECT id, category, list_distinct(string_split(name, ' ')) AS ts FROM n),
e AS (SELECT id, unnest(ts) AS token FROM t), d AS (SELECT token, count(*) AS df FROM e GROUP BY token HAVING count(*) BETWEEN 2 AND 350),
b AS (SELECT * FROM e JOIN d USING (token)),
p AS (SELECT DISTINCT x.id, y.id AS other FROM b x JOIN b y ON x.token = y.token AND x.id <> y.id),
s AS (
  SELECT p.id, p.other, round(least(0.95, 0.65 * len(list_intersect(a.ts, c.ts)) / (len(a.ts) + len(c.ts) - len(list_intersect(a.ts, c.ts))) + CASE WHEN a.category = c.category THEN 0.1 ELSE 0 END), 6) AS strength
  FROM p JOIN t a ON p.id = a.id JOIN t c ON p.other = c.id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY strength DESC, other) AS rank FROM s WHERE strength >= 0.22)
SELECT id, other, strength, rank::INTEGER AS rank FROM r WHERE rank <= 6""")
def lexical_confusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("id"), F.min("p_type").alias("category"))
    return graph.lexical_edges(names.withColumn("tokens", F.split("p_name", " ")), "tokens", "category", "id", [])


@query("""
WITH e AS (SELECT least(o_custkey, o_orderkey % 1500 + 1) AS l, greatest(o_custkey, o_orderkey % 1500 + 1) AS r, max(o_totalprice) AS strength FROM orders WHERE o_custkey <> o_orderkey % 1500 + 1 GROUP BY 1, 2),
b AS (SELECT l AS id, r AS other, strength FROM e UNION ALL SELECT r, l, strength FROM e),
v AS (SELECT b.*, row_number() OVER (PARTITION BY b.id, b.other // 3 ORDER BY strength DESC, other) AS k FROM b WHERE b.other // 3 <> b.id // 3),
r AS (SELECT id, other, strength, row_number() OVER (PARTITION BY id ORDER BY strength DESC, other) AS rank FROM v WHERE k = 1)
SELECT id, other, strength, rank::INTEGER AS rank FROM r WHERE rank <= 6""")
def symmetric_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 1500 + 1).alias("b"), F.lit("order").alias("reason"), F.col("o_totalprice").alias("strength"))
    edges = dedup.undirected(raw).select("left", "right", "strength")
    ids = graph.both_ways(edges).select("id").distinct()
    return graph.neighbours(edges, ids.withColumn("visual_key", F.floor(F.col("id") / 3)))


@query("""
WITH s AS (SELECT s_suppkey AS k, s_nationkey AS n, n_regionkey AS g, s_acctbal AS p FROM supplier JOIN nation ON s_nationkey = n_nationkey),
x AS (SELECT a.k AS id, b.k AS other, CASE WHEN a.n = b.n THEN 0 ELSE 1 END AS rung, abs(a.p - b.p) AS distance FROM s a JOIN s b ON a.g = b.g AND a.k <> b.k),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rung, distance, other) AS rank FROM x)
SELECT id, other, rung::INTEGER AS rung, rank::INTEGER AS rank FROM r WHERE rank <= 3""")
def fallback_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    rows = table(spark, sf_dir, "supplier").join(nation, "s_nationkey")
    return graph.fallback_neighbours(rows, [["s_nationkey"], ["n_regionkey"]], "s_suppkey", "s_acctbal", 3).select("id", "other", "rung", "rank")


@query(f"""
WITH {_NAMES}, w AS (SELECT string_split(name, ' ')[1] AS name, -min(id) AS id FROM n GROUP BY 1),
u AS (SELECT name AS stem, id FROM w), v AS (SELECT string_split(name, ' ')[1] AS stem, id AS other FROM n WHERE strpos(name, ' ') > 0),
r AS (SELECT u.id, other, abs(u.id - other) AS distance, row_number() OVER (PARTITION BY u.id ORDER BY abs(u.id - other), other) AS rank FROM u JOIN v USING (stem))
SELECT id, other, distance, rank::INTEGER AS rank FROM r WHERE rank <= 6""")
def prefix_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    stems = names.groupBy(F.split("name", " ")[0].alias("name")).agg((-F.min("id")).alias("id"))
    return graph.stem_neighbours(stems.unionByName(names), "name", "id", "id", " ")


_VOTES = """v AS (
  SELECT event_id // 3 AS claim, CASE WHEN event_type IN ('purchase', 'signup', 'click') THEN 'supported' WHEN event_type = 'view' THEN 'platform_specific'
         WHEN value > 60 THEN 'wrong' WHEN value > 30 THEN 'too_broad' ELSE 'duplicate' END AS verdict FROM events)"""


# majority floor(n / 2) + 1, rejected before verified before platform_specific before contested
@query(f"""
WITH {_VOTES}, t AS (
  SELECT claim, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE verdict = '{v}') AS {v}" for v in votes.VERDICTS)} FROM v GROUP BY claim),
s AS (
  SELECT *, too_broad + wrong + duplicate AS against, CASE WHEN too_broad + wrong + duplicate >= n // 2 + 1 THEN 'rejected'
    WHEN supported >= n // 2 + 1 AND too_broad + wrong + duplicate = 0 AND platform_specific = 0 THEN 'verified'
    WHEN supported + platform_specific >= n // 2 + 1 AND too_broad + wrong + duplicate = 0 AND platform_specific > 0 THEN 'platform_specific' ELSE 'contested' END AS status FROM t),
l AS (
  SELECT *, CASE status WHEN 'rejected' THEN against WHEN 'verified' THEN supported WHEN 'platform_specific' THEN supported + platform_specific
    ELSE greatest(supported, platform_specific, too_broad, wrong, duplicate) END AS support_count FROM s)
SELECT * EXCLUDE (against), round(support_count / n, 6) AS confidence FROM l""")
def vote_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, value = F.col("event_type"), F.col("value")
    against = F.when(value > 60, "wrong").when(value > 30, "too_broad").otherwise("duplicate")
    verdict = F.when(t.isin("purchase", "signup", "click"), "supported").when(t == "view", "platform_specific").otherwise(against)
    own = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 3).alias("claim"), verdict.alias("verdict"))
    return votes.verification(own, "claim", "verdict")


@query("""
WITH v AS (SELECT user_id AS c, event_type AS k, event_id % 5 AS v, max(value) AS p FROM events GROUP BY 1, 2, 3),
f AS (SELECT *, row_number() OVER (PARTITION BY c, v ORDER BY p DESC, k) = 1 AS first FROM v),
n AS (SELECT c, count(DISTINCT v) AS n FROM v GROUP BY c),
b AS (SELECT c, k, sum(p) AS p, count(*) FILTER (WHERE first) AS wins, min(v) FILTER (WHERE first) AS won FROM f GROUP BY c, k),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY wins DESC, p DESC, won, k) AS r FROM b)
SELECT c AS user_id, k AS winner, round(p / n, 6) AS mean_p, wins::BIGINT AS wins, round(wins / n, 6) AS agreement FROM r JOIN n USING (c) WHERE r = 1""")
def adjudication_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = table(spark, sf_dir, "events").groupBy("user_id", "event_type", (F.col("event_id") % 5).alias("vote")).agg(F.max("value").alias("p"))
    return votes.adjudication(cast, "user_id", "event_type", "vote", "p")


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c)
SELECT user_id, round(-sum(p * log2(p)), 6) AS entropy FROM p GROUP BY user_id""")
def distribution_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return votes.entropy(counted, "user_id", F.col("n"))


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c),
w AS (SELECT user_id, arg_max(event_type, (n, event_type)) AS better, max(p) AS top FROM p GROUP BY user_id)
SELECT user_id AS "case", better, event_type AS worse, round(top - p, 6) AS margin FROM p JOIN w USING (user_id) WHERE event_type <> better AND round(top - p, 6) >= 0.15""")
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    shares = counted.withColumn("p", F.col("n") / F.sum("n").over(W.partitionBy("user_id")))
    cases = shares.groupBy(F.col("user_id").alias("case")).agg(F.max_by("event_type", F.struct("n", "event_type")).alias("winner"), F.map_from_entries(F.collect_list(F.struct("event_type", "p"))).alias("p"))
    return votes.preference_pairs(cases)


@query("""
WITH v AS (SELECT user_id AS entity_id, event_type AS phrase, event_id % 4 AS vote, 'e' || (event_id % 3) AS evidence FROM events),
n AS (SELECT entity_id, count(DISTINCT vote) AS n FROM v GROUP BY 1)
SELECT entity_id, phrase, count(DISTINCT vote) AS support, array_to_string(list_sort(list(DISTINCT evidence)), ',') AS evidence, round(count(DISTINCT vote) / any_value(n), 6) AS confidence
FROM v JOIN n USING (entity_id) WHERE phrase <> 'error' GROUP BY entity_id, phrase""")
def merged_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id"), F.col("event_type").alias("phrase"), (F.col("event_id") % 4).alias("vote"), F.concat(F.lit("e"), F.col("event_id") % 3).alias("evidence"))
    return votes.merged_claims(v, ["entity_id", "phrase"], F.col("phrase") == "error").withColumn("evidence", F.array_join("evidence", ","))


@query("""
WITH s AS (SELECT DISTINCT p_partkey AS id, lower(p_name) AS name, upper(p_type) AS kind FROM part)
SELECT min(id) AS id, kind || ':' || name AS visual FROM s GROUP BY 2""")
def unique_visual_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat(F.upper("p_type"), F.lit(":"), F.lower("p_name")).alias("visual"))
    return selection.unique_visual(parts, "id", "visual", "id")


@query("""
WITH f AS (SELECT s_nationkey AS target, (s_nationkey + 3) % 25 AS thief, s_suppkey % 4 AS c, s_suppkey % 7 AS v FROM supplier),
r AS (SELECT target AS k, 'target' AS role, greatest(1, c) AS c, least(5, greatest(1, v)) AS v FROM f UNION ALL SELECT thief, 'competitor', greatest(1, c), least(5, greatest(1, v)) FROM f)
SELECT k::VARCHAR AS key, sum(c)::BIGINT AS count, max(v)::INTEGER AS severity, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles FROM r GROUP BY k""")
def failure_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("target_key"),
        F.array(((F.col("s_nationkey") + 3) % 25).cast("string")).alias("thief_keys"),
        (F.col("s_suppkey") % 4).alias("count"),
        (F.col("s_suppkey") % 7).cast("int").alias("severity"),
    )
    return selection.failure_rollup(f).withColumn("roles", F.array_join("roles", ","))


# the walk itself: whose turn it is, and how many each category has given
@query("""
WITH RECURSIVE c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
s AS (
  SELECT 0 AS pick, 0 AS turn, list(p_brand ORDER BY p_brand) AS names, list(n ORDER BY p_brand) AS left_, list(0::BIGINT ORDER BY p_brand) AS took, NULL::VARCHAR AS chosen, 0::BIGINT AS nth FROM c
  UNION ALL
  SELECT pick + 1, CASE WHEN left_[i] = 1 THEN turn ELSE turn + 1 END,
         CASE WHEN left_[i] = 1 THEN names[1:i - 1] || names[i + 1:] ELSE names END,
         CASE WHEN left_[i] = 1 THEN left_[1:i - 1] || left_[i + 1:] ELSE left_[1:i - 1] || [left_[i] - 1] || left_[i + 1:] END,
         CASE WHEN left_[i] = 1 THEN took[1:i - 1] || took[i + 1:] ELSE took[1:i - 1] || [took[i] + 1] || took[i + 1:] END,
         names[i], took[i] + 1
  FROM (SELECT *, (turn % len(names) + 1)::BIGINT AS i FROM s WHERE pick < 200 AND len(names) > 0)),
r AS (SELECT p_brand, p_retailprice, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS nth FROM part)
SELECT r.p_brand, p_retailprice, p_partkey, pick::BIGINT AS pick FROM s JOIN r ON s.chosen = r.p_brand AND s.nth = r.nth""")
def rotating_exploration(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_brand", "p_retailprice", "p_partkey")
    return sampling.rotating_fill(parts, "p_brand", ["p_retailprice", "p_partkey"], 200)


@query(r"""
SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) AS term, trim(regexp_replace(lower(nfc_normalize(text)), '[^\p{L}\p{N}]+', ' ', 'g')) AS record_text FROM documents""")
def normalised_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.normalised_term("text").alias("term"), tx.normalised_record_text("text").alias("record_text"))


_CLAIMS = """
c AS (
  SELECT p_partkey AS claim_id, p_brand AS entity_id, lower(p_name) AS normalized_phrase, p_name AS phrase,
         CASE p_size % 4 WHEN 0 THEN 'verified' WHEN 1 THEN 'proposed' WHEN 2 THEN 'platform_specific' ELSE 'contested' END AS status,
         p_size / 50.0 AS confidence, CASE p_size % 3 WHEN 0 THEN 'identity' WHEN 1 THEN 'usage' ELSE 'visual' END AS family
  FROM part)"""


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("claim_id"),
        F.col("p_brand").alias("entity_id"),
        F.lower("p_name").alias("normalized_phrase"),
        F.col("p_name").alias("phrase"),
        F.when(size % 4 == 0, "verified").when(size % 4 == 1, "proposed").when(size % 4 == 2, "platform_specific").otherwise("contested").alias("status"),
        (size / F.lit(50.0)).alias("confidence"),
        F.when(size % 3 == 0, "identity").when(size % 3 == 1, "usage").otherwise("visual").alias("family"),
    )


@query(f"""WITH {_CLAIMS}
SELECT claim_id, row_number() OVER (PARTITION BY entity_id, normalized_phrase ORDER BY (status IN ('verified', 'platform_specific')) DESC, confidence DESC, claim_id) > 1 AS duplicate FROM c""")
def canonical_claim_per_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.canonical_claims(_claims(spark, sf_dir)).select("claim_id", "duplicate")


@query(f"""WITH {_CLAIMS}, d AS (SELECT normalized_phrase, count(DISTINCT entity_id) AS df FROM c GROUP BY 1),
w AS (
  SELECT entity_id AS target_key, c.normalized_phrase AS normalized_term, phrase AS term,
    greatest(0.25, least(1.0, confidence * CASE family WHEN 'identity' THEN 1.0 WHEN 'usage' THEN 0.93 ELSE 0.86 END * CASE WHEN status = 'platform_specific' THEN 0.82 ELSE 1.0 END / greatest(1.0, log2(df + 1)))) AS weight
  FROM c JOIN d USING (normalized_phrase) WHERE confidence >= 0.62 AND df <= 12 AND NOT (status = 'platform_specific' AND confidence < 0.78)),
r AS (SELECT *, row_number() OVER (PARTITION BY target_key, normalized_term ORDER BY weight DESC, term) AS r FROM w)
SELECT target_key, normalized_term, round(weight, 6) AS weight FROM r WHERE r = 1""")
def search_term_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _claims(spark, sf_dir).withColumns({"target_kind": F.lit("part"), "target_key": F.col("entity_id")})
    none = own.where("false").select("target_kind", "target_key", F.col("phrase").alias("query"), F.col("confidence").alias("agreement"))
    return claims.search_terms(own, none).select("target_key", "normalized_term", F.round("weight", 6).alias("weight"))


@query(f"""WITH {_CLAIMS}, e AS (SELECT 'Brand#' || (n_nationkey + 1) AS entity_id FROM nation),
n AS (SELECT e.entity_id, count(c.claim_id) AS n FROM e LEFT JOIN (SELECT * FROM c WHERE status = 'verified') c USING (entity_id) GROUP BY 1),
s AS (SELECT list_sort(list(n)) AS v, count(*) AS k, sum(n) AS claims, count(*) FILTER (WHERE n > 0) AS covered FROM n)
SELECT k AS entities, claims::BIGINT AS claims, covered, covered::DOUBLE / k AS coverage_rate, v[1] AS p0, v[1 + floor((k - 1) * 0.5)::INT] AS p50, v[1 + floor((k - 1) * 0.9)::INT] AS p90, v[k::INT] AS p100 FROM s""")
def alias_coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = table(spark, sf_dir, "nation").select(F.concat(F.lit("Brand#"), F.col("n_nationkey") + 1).alias("entity_id"))
    return claims.alias_report(entities, _claims(spark, sf_dir).where("status = 'verified'"))
