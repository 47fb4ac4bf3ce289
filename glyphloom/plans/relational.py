"""Relational queries: reports, merges, pivots, state folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.operators import dedup, reports, sampling, state
from glyphloom.plans.base import query, table


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)")
def orphan_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orphans(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return reports.orphans(table(spark, sf_dir, "orders").select("o_orderkey"), items, ["o_orderkey"])


@query("""
WITH e AS (SELECT l_orderkey AS o_orderkey, max(l_linenumber) AS claimed, count(*) AS actual FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(claimed, 0)::BIGINT AS claimed, coalesce(actual, 0) AS actual FROM orders LEFT JOIN e USING (o_orderkey)
WHERE coalesce(claimed, 0) <> coalesce(actual, 0)""")
def count_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    # both facts come from one aggregation of the lines
    facts = items.groupBy("o_orderkey").agg(F.max("l_linenumber").alias("claimed"), F.count(F.lit(1)).alias("actual"))
    joined = table(spark, sf_dir, "orders").select("o_orderkey").join(facts, "o_orderkey", "left")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    return joined.select("o_orderkey", zero("claimed").alias("claimed"), zero("actual").alias("actual")).where("claimed <> actual")


@query("""
SELECT o_custkey AS c_custkey, c.claimed, c.actual FROM (
  SELECT c_custkey AS o_custkey, c_nationkey::BIGINT AS claimed, coalesce(n, 0) AS actual FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON c_custkey = o.o_custkey) c
WHERE claimed <> actual""")
def claimed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return reports.count_mismatches(customers, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "c_nationkey")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING max((event_type = 'purchase')::INT) = 1 AND max((event_type = 'error' AND value > 150)::INT) = 0")
def exclusive_kind_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    return reports.exclusive_groups(table(spark, sf_dir, "events"), "user_id", t == "purchase", (t == "error") & (F.col("value") > 150))


@query("""
WITH r AS (SELECT unnest(string_split(p_name, ' ')) AS rule, p_partkey, p_brand FROM part)
SELECT rule, count(*) AS n, count(DISTINCT (p_brand, p_partkey)) AS subjects FROM r WHERE rule <> '' GROUP BY rule""")
def explode_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rule_counts(table(spark, sf_dir, "part"), F.split("p_name", " "), ["p_brand", "p_partkey"])


@query("SELECT event_type, floor(value / 10)::BIGINT AS score, count(*) AS n FROM events GROUP BY 1, 2")
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(table(spark, sf_dir, "events").select("event_type", F.floor(F.col("value") / 10).alias("score")), ["event_type", "score"])


@query("""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY o_orderpriority""")
def status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_pivot(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])


@query("""
SELECT p_brand, p_partkey, r::INTEGER AS pick FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part)
ORDER BY r, p_brand LIMIT 120""")
def stratified_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice")
    return sampling.stratified_round_robin(parts, "p_brand", [F.col("p_retailprice").desc(), F.col("p_partkey")], 120).select("p_brand", "p_partkey", "pick")


@query("""
WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
s AS (SELECT list_sort(list(n)) AS v, count(*) AS c FROM n)
SELECT v[1 + floor((c - 1) * 0.1)::INT] AS p10, v[1 + floor((c - 1) * 0.5)::INT] AS p50, v[1 + floor((c - 1) * 0.9)::INT] AS p90 FROM s""")
def floor_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return reports.floor_percentiles(n, "n", [0.1, 0.5, 0.9])


_METRICS = """
m AS (
  SELECT count(*) AS total, count(l.doc_id) AS labelled, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT *, CASE WHEN total = 0 THEN 0 ELSE labelled::DOUBLE / total END AS coverage, CASE WHEN labelled = 0 THEN 0 ELSE good::DOUBLE / labelled END AS quality FROM m)"""


@query(f"""WITH {_METRICS}
SELECT array_to_string(list_filter([CASE WHEN NOT total >= 20000 THEN 'size' END, CASE WHEN NOT coverage >= 0.3 THEN 'coverage' END,
  CASE WHEN NOT quality >= 0.9 THEN 'quality' END, CASE WHEN NOT toxic = 0 THEN 'toxic' END], lambda x: x IS NOT NULL), ',') AS failed,
  total >= 20000 AND coverage >= 0.3 AND quality >= 0.9 AND toxic = 0 AS publishable FROM r""")
def coverage_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").withColumn("_l", F.lit(1)), "doc_id", "left")
    m = joined.agg(F.count(F.lit(1)).alias("total"), F.count("_l").alias("labelled"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    gates = [("size", F.col("total") >= 20000), ("coverage", reports.rate(F.col("labelled"), F.col("total")) >= 0.3), ("quality", reports.rate(F.col("good"), F.col("labelled")) >= 0.9), ("toxic", F.col("toxic") == 0)]
    return reports.failed_gates(m, gates)


@query("""
SELECT coalesce(c.c_custkey, o.k) AS k, CASE WHEN p IS NULL THEN c_acctbal WHEN c_acctbal IS NULL THEN p ELSE greatest(c_acctbal, p) END AS best, coalesce(s, c_mktsegment) AS label
FROM customer c FULL JOIN (SELECT o_custkey AS k, max(o_totalprice) AS p, max(o_orderstatus) AS s FROM orders GROUP BY 1) o ON c.c_custkey = o.k""")
def max_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("best"), F.col("c_mktsegment").alias("label"))
    new = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("best"), F.max("o_orderstatus").alias("label"))
    return dedup.merged(old, new, ["k"], {"best": "max", "label": "new"})


@query("""
SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.v ELSE o.v END AS v, n.k IS NOT NULL AS active
FROM (SELECT s_suppkey AS k, s_acctbal AS v FROM supplier WHERE s_nationkey < 15) o
FULL JOIN (SELECT s_suppkey AS k, s_acctbal + 1 AS v FROM supplier WHERE s_nationkey > 8) n ON o.k = n.k""")
def replaced_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    old = s.where("s_nationkey < 15").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    new = s.where("s_nationkey > 8").select(F.col("s_suppkey").alias("k"), (F.col("s_acctbal") + 1).alias("v"))
    return dedup.replaced_selection(old, new, ["k"], ["v"])


@query("""
SELECT event_type, count(*) AS n, sum((props->>'k')::BIGINT)::BIGINT AS total, max(len(json_keys(props)))::INTEGER AS most_keys FROM events GROUP BY event_type""")
def json_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"), F.max(F.size(F.json_object_keys("props"))).alias("most_keys"))


@query("""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(value) AS observed, count(*) FILTER (WHERE event_type = 'error') AS warnings,
       min(ts) AS started, max(ts) AS updated, count(*) AS events FROM events GROUP BY user_id""")
def run_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.run_state(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id")


_TRANSITIONS = """
e AS (SELECT user_id || ':' || strftime(ts, '%Y-%m-%d') AS unit, * FROM events),
t AS (SELECT unit, event_id, ts, CASE event_type WHEN 'click' THEN 'begin' WHEN 'view' THEN 'progress' WHEN 'purchase' THEN 'finish' WHEN 'error' THEN 'fail' ELSE 'transport' END AS event FROM e),
c AS (SELECT unit, arg_max(CASE event WHEN 'begin' THEN 'running' WHEN 'finish' THEN 'complete' WHEN 'fail' THEN 'failed' WHEN 'transport' THEN 'failed' END, (ts, event_id))
        FILTER (WHERE event <> 'progress') AS status,
      greatest(0, count(*) FILTER (WHERE event = 'begin') - count(*) FILTER (WHERE event = 'transport')) AS attempts, count(*) FILTER (WHERE event = 'transport') AS operational_failures
      FROM t GROUP BY unit)"""


@query(f"""WITH {_TRANSITIONS}
SELECT u.unit, u.rank, CASE WHEN status = 'failed' THEN 0 WHEN status = 'quarantined' THEN 1 WHEN status IN ('stale', 'pending') THEN 2 ELSE 3 END AS rung
FROM (SELECT unit, count(*) AS rank FROM e GROUP BY unit) u LEFT JOIN c USING (unit)
WHERE status IS NULL OR (status IN ('failed', 'quarantined', 'stale', 'pending') AND attempts < 2 AND operational_failures < 6)
ORDER BY rung, rank, unit LIMIT 40""")
def checkpoint_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events of a day are the transitions of one unit of work."""
    unit = F.concat(F.col("user_id").cast("string"), F.lit(":"), F.date_format("ts", "yyyy-MM-dd"))
    events = table(spark, sf_dir, "events").withColumn("unit", unit)
    names = {"click": "begin", "view": "progress", "purchase": "finish", "error": "fail"}
    kind = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("event_type")], F.lit("transport"))
    own = state.replayed(events.select("unit", "event_id", "ts", kind.alias("event")), ["unit"], ["ts", "event_id"])
    entities = events.groupBy("unit").agg(F.count(F.lit(1)).alias("rank"))
    return state.eligible(entities, own, "unit", "rank", 40)


@query("""
WITH k AS (SELECT *, epoch_us(ts) / 1e6 AS sec, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f AS (SELECT *, greatest(min(k) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW), k - 63) AS f FROM k)
SELECT f.user_id, f.ts, f.event_id, CASE WHEN f.k > f.f AND f.sec - g.sec >= 0.25 AND f.value - g.value >= 0 THEN round((f.value - g.value) / (f.sec - g.sec), 6) END AS rate
FROM f JOIN k g ON f.user_id = g.user_id AND f.f = g.k""")
def progress_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.progress_rate(table(spark, sf_dir, "events"), ["user_id"], "ts", "value", "event_id", seconds=86400)


# from each row that goes out to the first that is an hour later; what is left behind the last one goes out at the end
@query("""
WITH RECURSIVE e AS (SELECT *, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events),
o AS (
  SELECT event_type, us, k FROM e WHERE k = 1
  UNION ALL SELECT n.event_type, n.us, n.k FROM (
    SELECT e.event_type, e.us, e.k, row_number() OVER (PARTITION BY e.event_type ORDER BY e.k) AS r FROM o JOIN e ON e.event_type = o.event_type AND e.us >= o.us + 3600000000) n WHERE n.r = 1),
l AS (SELECT event_type, max(k) AS k FROM e GROUP BY 1),
b AS (SELECT event_type, k FROM o UNION SELECT event_type, k FROM l),
s AS (SELECT event_type, k, coalesce(lag(k) OVER (PARTITION BY event_type ORDER BY k), 0) AS before FROM b)
SELECT s.event_type, arg_max(ts, e.k) AS ts, arg_max(event_id, e.k) AS event_id, round(sum(value), 4) AS value, count(*) AS merged
FROM s JOIN e ON e.event_type = s.event_type AND e.k > s.before AND e.k <= s.k GROUP BY s.event_type, s.k""")
def throttled_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.throttled(table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value"), ["event_type"], "ts", "event_id", "value", seconds=3600)
    return out.withColumn("value", F.round("value", 4))


@query("""
SELECT d.source, count(*) AS expected, count(*) FILTER (WHERE l.quality = 1) AS accepted, count(*) FILTER (WHERE l.quality IS NULL OR l.quality <> 1) AS missing
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source""")
def cohort_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return reports.cohort_audit(table(spark, sf_dir, "documents").select("source", "doc_id"), good, "source", "doc_id")


@query("SELECT lang AS label, quality AS decision, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return reports.confusion_matrix(joined, "lang", "quality")


@query("""
SELECT 'customer' AS name, count(*) AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderpriority IN ('BUILDING', 'MACHINERY', '1-URGENT')""".replace(", '1-URGENT'", ""))
def purge_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"customer": table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "site"), "orders": table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "site")}
    return dedup.purge_plan(tables, ["BUILDING", "MACHINERY"])


@query("SELECT DISTINCT n_nationkey AS k FROM nation UNION SELECT c_nationkey FROM customer")
def distinct_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")).union(table(spark, sf_dir, "customer").select("c_nationkey")).distinct()
