"""Queries over threads, search, glyphs and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.functions import text as tx
from glyphloom.operators import dedup, graph, index, retrieval, sampling, search, threads
from glyphloom.plans.base import query, table

_WORDS = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}\p{{M}}]*')"
_DOCS = """
docs AS (
  SELECT conv_id AS qid, conv_id * 1000 + turn AS docid, CASE WHEN turn = 0 THEN conv_id ELSE conv_id * 1000 + turn END AS post_id, text,
    CASE WHEN role = 'assistant' THEN 'answer' WHEN role = 'system' THEN 'history'
         WHEN turn = min(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) THEN 'question' ELSE 'comment' END AS role
  FROM conversations)"""
# The invented prose has no character language, so an assessment by length stands in for the classifier's.
_ASSESSED = """
assessed AS (
  SELECT *, CASE WHEN length(text) % 7 = 0 THEN 'character_request' WHEN length(text) % 7 = 1 THEN 'character_discussion'
                 WHEN length(text) % 7 = 2 THEN 'review' WHEN length(text) % 7 < 5 THEN 'context_only' ELSE 'unrelated' END AS status,
         CASE length(text) % 7 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 1 WHEN 4 THEN 1 ELSE 0 END AS score,
         length(text) % 5 = 0 AS identity, length(text) % 3 = 0 AS picture
  FROM docs)"""
_THREADS = """
threads AS (
  SELECT qid, request, image, evidence, discussion, historical_request, score,
    CASE WHEN request AND evidence THEN 'request_with_evidence' WHEN request THEN 'request_only' WHEN image THEN 'needs_image' WHEN evidence THEN 'evidence_only'
         WHEN discussion THEN 'discussion' WHEN historical_request THEN 'historical_request' WHEN score = 3 THEN 'review'
         WHEN score > 0 THEN 'context_only' ELSE 'unrelated' END AS status
  FROM (SELECT qid, bool_or(status = 'character_request' AND role IN ('question', 'comment')) AS request,
               bool_or(picture AND role IN ('question', 'comment')) AS image,
               bool_or(identity AND role <> 'history') AS evidence,
               bool_or(status IN ('character_request', 'character_discussion') AND role <> 'history') AS discussion,
               bool_or(status = 'character_request' AND role = 'history' AND post_id = qid) AS historical_request, max(score) AS score
        FROM assessed GROUP BY qid))"""


def assessed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = threads.conversation_documents(table(spark, sf_dir, "conversations"))
    m = F.length("text") % 7
    status = F.when(m == 0, "character_request").when(m == 1, "character_discussion").when(m == 2, "review").when(m < 5, "context_only").otherwise("unrelated")
    score = F.when(m == 0, 8).when(m == 1, 4).when(m == 2, 3).when(m < 5, 1).otherwise(0)
    parts = [F.when(F.length("text") % n == 0, F.lit(route)) for n, route in ((5, "identity_evidence"), (3, "needs_image"))]
    routes = F.filter(F.array(*parts), lambda r: r.isNotNull())
    return threads.flags(docs.select("*", status.alias("status"), score.alias("score"), routes.alias("routes")))


@query(f"WITH {_DOCS}, {_ASSESSED}, {_THREADS} SELECT * FROM threads")
def thread_rollup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.rollup(assessed_documents(spark, sf_dir), ["qid"])


def _bm25_sql(source: str, key: str, terms: list[str]) -> str:
    words = _WORDS.format("text")
    parts, idfs = [], []
    for k, t in enumerate(terms):
        parts.append(f"len(list_filter(ws, lambda w: w = '{t}')) AS tf{k}")
        idfs.append(f"(SELECT CASE WHEN ln((n - df{k} + 0.5) / (df{k} + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df{k} + 0.5) / (df{k} + 0.5)) END FROM facts) * tf{k} * 2.2 / (tf{k} + 1.2 * (0.25 + 0.75 * len / (SELECT avglen FROM facts)))")
    return f"""
words AS (SELECT {key}, {words} AS ws FROM {source}),
counted AS (SELECT {key}, len(ws) AS len, {", ".join(parts)} FROM words),
facts AS (SELECT count(*) AS n, avg(len) AS avglen, {", ".join(f"count(*) FILTER (WHERE tf{k} > 0) AS df{k}" for k in range(len(terms)))} FROM counted),
scored AS (SELECT {key}, round(-({" + ".join(idfs)}), 6) AS relevance FROM counted WHERE {" AND ".join(f"tf{k} > 0" for k in range(len(terms)))})"""


_TERMS = ["that", "with"]


@query(f"""WITH {_DOCS}, {_ASSESSED}, {_THREADS}, {_bm25_sql("docs", "docid", _TERMS)},
found AS (
  SELECT a.qid, a.docid, a.role, t.status AS thread_status, s.relevance,
         row_number() OVER (PARTITION BY a.qid ORDER BY (a.role <> 'history') DESC, (a.status = 'character_request') DESC, s.relevance, a.docid) AS r
  FROM scored s JOIN assessed a USING (docid) JOIN threads t ON a.qid = t.qid
  WHERE t.status NOT IN ('unrelated', 'context_only') AND a.status NOT IN ('unrelated', 'context_only', 'review'))
SELECT qid, docid, role, thread_status, relevance FROM found WHERE r = 1
ORDER BY (role <> 'history') DESC, (thread_status = 'request_with_evidence') DESC, (thread_status = 'request_only') DESC, relevance, qid LIMIT 50""")
def best_doc_per_thread(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = assessed_documents(spark, sf_dir)
    ranked = search.bm25(sources, "docid", "text", _TERMS).withColumn("relevance", F.round("relevance", 6))
    rolled = threads.rollup(sources, ["qid"]).select("qid", F.col("status").alias("thread_status"), F.col("request").alias("_asked"))
    rows = ranked.join(sources.select("docid", "qid", "role", F.col("status").alias("source_status")), "docid").join(rolled, "qid").withColumn("explicit", F.lit(False))
    best = search.best_of_thread(search.in_scope(rows, "relevant"), ["qid"])
    return search.result_page(best, 50).select("qid", "docid", "role", "thread_status", "relevance")


@query(f"""WITH {_bm25_sql("documents", "doc_id", ["that", "with"])} SELECT doc_id, relevance FROM scored""")
def bm25_word_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.bm25(table(spark, sf_dir, "documents"), "doc_id", "text", _TERMS).withColumn("relevance", F.round("relevance", 6))


_INDEX_TERMS = ["that", "with"]
_INDEXED = r"""
words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}][\p{L}\p{N}\p{M}]*') AS ws,
                 len(list_distinct(regexp_extract_all(coalesce(text, ''), '[^\s\p{Z}\x1c-\x1f\x85]'))) AS glyphs, coalesce(text, '') AS t FROM documents),
contents AS (SELECT t, min(doc_id) AS cid, any_value(ws) AS ws, any_value(len(ws) + glyphs) AS length FROM words GROUP BY t),
counted AS (SELECT cid, t, length, len(list_filter(ws, lambda w: w = 'that')) AS a, len(list_filter(ws, lambda w: w = 'with')) AS b FROM contents),
facts AS (SELECT count(*) AS n, avg(length) AS l, count(*) FILTER (WHERE a > 0) AS na, count(*) FILTER (WHERE b > 0) AS nb FROM counted),
scored AS (
  SELECT t, greatest(ln((n - na + 0.5) / (na + 0.5)), 0) AS ia, greatest(ln((n - nb + 0.5) / (nb + 0.5)), 0) AS ib, a, b, 1.2 * (0.25 + 0.75 * length / l) AS k FROM counted, facts WHERE a > 0 AND b > 0)"""


def _index(spark: SparkSession, sf_dir: str) -> index.Index:
    """The index of the documents, built where the session has none that is up to date."""
    source = f"{sf_dir}/documents.parquet"
    path = f"{index.shared_folder(spark)}/glyphloom-index-{index.fingerprint(spark, source)[:16]}"
    try:
        return index.Index(spark, path, source)
    except index.StaleIndex:
        index.build(spark, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("docid"), "text", "lang"), source, path)
        return index.Index(spark, path, source)


@query(f"""WITH {_INDEXED}
SELECT doc_id, round(-(CASE WHEN ia > 0 THEN ia ELSE 1e-6 END * a * 2.2 / (a + k) + CASE WHEN ib > 0 THEN ib ELSE 1e-6 END * b * 2.2 / (b + k)), 6) AS relevance
FROM scored JOIN words USING (t)""")
def indexed_word_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _index(spark, sf_dir)
    return own.sources(own.words(" ".join(_INDEX_TERMS))).select(F.col("docid").alias("doc_id"), F.round("relevance", 6).alias("relevance"))


@query("SELECT doc_id FROM documents WHERE contains(text, 'thea of')")
def indexed_literal_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _index(spark, sf_dir)
    return own.sources(own.literal("thea of")).select(F.col("docid").alias("doc_id"))


@query("SELECT doc_id FROM documents WHERE contains(text, 'é')")
def indexed_code_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _index(spark, sf_dir)
    return own.sources(own.code_point(0xE9)).select(F.col("docid").alias("doc_id"))


@query("SELECT doc_id, substr(text, greatest(1, strpos(lower(text), 'thea of') - 100), 700) AS excerpt FROM documents WHERE contains(text, 'thea of')")
def literal_search_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.literal_matches(table(spark, sf_dir, "documents"), "text", "thea of")
    return found.select("doc_id", tx.excerpt(F.col("text"), "thea of").alias("excerpt"))


@query(r"""
SELECT doc_id, array_to_string(list_sort(list_transform(list_distinct(regexp_extract_all(text, '[^\x00-\x7F]')),
         lambda c: 'cp' || lpad(lower(hex(unicode(c))), 6, '0'))), ' ') AS tokens FROM documents""")
def glyph_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.glyph_tokens(F.col("text")).alias("tokens"))


@query("SELECT doc_id FROM documents WHERE contains(text, 'é') AND contains(text, 'ç')")
def code_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.code_point_matches(table(spark, sf_dir, "documents"), "text", [0xE9, 0xE7]).select("doc_id")


@query(r"""
WITH l AS (SELECT doc_id, 'see U+' || upper(lpad(hex(unicode(regexp_extract(text, '[^\x00-\x7F]'))), 4, '0')) || ' and U+D800, xU+0041' AS t
           FROM documents WHERE regexp_matches(text, '[^\x00-\x7F]'))
SELECT doc_id, unicode(regexp_extract(text, '[^\x00-\x7F]'))::BIGINT AS code_point FROM documents JOIN l USING (doc_id)""")
def codepoint_label_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    first = F.regexp_extract("text", r"([^\x00-\x7F])", 1)
    label = F.concat(F.lit("see U+"), F.upper(F.lpad(F.hex(F.ascii(first).cast("long")), 4, "0")), F.lit(" and U+D800, xU+0041"))
    return docs.where(first != "").select("doc_id", F.explode(tx.labelled_code_points(label)).alias("code_point"))


@query("""
WITH h AS (SELECT doc_id, sha256(coalesce(text, '')) AS hash FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY hash) AS cid FROM h""")
def content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = dedup.content_keys(table(spark, sf_dir, "documents"), "text", "doc_id")
    return records


@query("""
SELECT lang, doc_id, sha256(source || ':' || doc_id) AS rank_hash FROM documents
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256(source || ':' || doc_id), doc_id) <= 20""")
def bottom_k_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", "source")
    rank = F.sha2(F.concat(F.col("source"), F.lit(":"), F.col("doc_id")), 256)
    return sampling.bottom_k(docs, ["lang"], rank, 20, ["doc_id"]).select("lang", "doc_id", "rank_hash")


@query("SELECT DISTINCT conv_id, sha256('conversations:' || conv_id) AS sample_hash FROM conversations ORDER BY sample_hash, conv_id LIMIT 25")
def audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return sampling.audit_sample(conversations, F.sha2(F.concat(F.lit("conversations:"), F.col("conv_id")), 256), 25, ["conv_id"])


@query("""
WITH l AS (
  SELECT conv_id AS qid, role, turn, CASE length(text) % 4 WHEN 0 THEN 'identity' WHEN 1 THEN 'context' WHEN 2 THEN 'semantics' ELSE 'noise' END AS lane FROM conversations),
d AS (
  SELECT l.*, CASE WHEN l.role = 'assistant' THEN 'answer' WHEN l.role = 'system' THEN 'history' ELSE 'question' END AS r FROM l),
f AS (
  SELECT qid, bool_or(lane = 'identity' AND r = 'question') AS asked, bool_or(lane = 'semantics') AS semantics,
         bool_or(lane = 'identity' AND r = 'answer') AS answered, bool_or(lane = 'identity' AND r = 'history') AS history, bool_or(lane = 'context') AS context
  FROM d GROUP BY qid)
SELECT qid, CASE WHEN asked THEN 'identity' WHEN semantics AND answered THEN 'mixed' WHEN history THEN 'historical' WHEN answered THEN 'evidence_only'
                 WHEN context THEN 'context' WHEN semantics THEN 'semantics' ELSE 'noise' END AS lane FROM f""")
def thread_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = threads.conversation_documents(table(spark, sf_dir, "conversations"))
    m = F.length("text") % 4
    lane = F.when(m == 0, "identity").when(m == 1, "context").when(m == 2, "semantics").otherwise("noise")
    return threads.thread_lane(docs.select("qid", "role", lane.alias("lane"), F.lit(True).alias("of_question")), ["qid"])


@query("""
SELECT conv_id AS qid, count(*) AS n_documents, string_agg(role || '#' || turn, ',' ORDER BY CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END, turn) AS layout
FROM conversations GROUP BY conv_id""")
def thread_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "post").when(F.col("role") == "assistant", "comment").otherwise("history")
    docs = c.select(F.lit("local").alias("site"), F.col("conv_id").alias("qid"), kind.alias("kind"), F.col("turn").alias("id"), F.col("role").alias("raw"))
    none = docs.where("false")
    whole = threads.assembled(docs, none.withColumn("score", F.lit(0)), none.select("site", F.col("qid").alias("a"), F.col("id").alias("b")), ["site", "qid"])
    return whole.select("qid", F.size("documents").cast("long").alias("n_documents"), F.array_join(F.transform("documents", lambda d: F.concat(d["raw"], F.lit("#"), d["id"])), ",").alias("layout"))


# The first blocks of the code space.
BLOCKS = [
    (0x0000, 0x007F, "Basic Latin"),
    (0x0080, 0x00FF, "Latin-1 Supplement"),
    (0x0100, 0x017F, "Latin Extended-A"),
    (0x0180, 0x024F, "Latin Extended-B"),
    (0x2000, 0x206F, "General Punctuation"),
    (0x20A0, 0x20CF, "Currency Symbols"),
    (0x2190, 0x21FF, "Arrows"),
    (0x2200, 0x22FF, "Mathematical Operators"),
]
_BLOCK_ROWS = ", ".join(f"({a}, {b}, '{n}')" for a, b, n in BLOCKS)


@query(f"""
WITH c AS (SELECT DISTINCT unicode(unnest(list_distinct(regexp_extract_all(text, '(?s).')))) AS cp FROM documents),
b(low, high, block) AS (VALUES {_BLOCK_ROWS})
SELECT cp::INTEGER AS cp, block FROM c LEFT JOIN b ON cp BETWEEN low AND high""")
def range_lookup_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(tx.characters(F.col("text")))).alias("c")).distinct()
    return graph.range_lookup(chars.select(tx.code_point(F.col("c")).alias("cp")).distinct(), "cp", BLOCKS)


@query("""
WITH c AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '(?s).'))) AS c FROM documents),
g AS (SELECT doc_id, CASE WHEN regexp_matches(c, '^\\p{L}') THEN 'letter' WHEN regexp_matches(c, '^\\p{M}') THEN 'mark' WHEN regexp_matches(c, '^\\p{N}') THEN 'number'
  WHEN regexp_matches(c, '^\\p{P}') THEN 'punctuation' WHEN regexp_matches(c, '^\\p{S}') THEN 'symbol' WHEN regexp_matches(c, '^\\p{Z}') THEN 'separator' ELSE 'other' END AS grp FROM c)
SELECT grp, count(*) AS characters, count(DISTINCT doc_id) AS documents FROM g GROUP BY grp""".replace("\\\\", "\\"))
def character_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphloom.operators.selection import general_group

    chars = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(tx.characters(F.col("text")))).alias("c"))
    return chars.groupBy(general_group(F.col("c")).alias("grp")).agg(F.count(F.lit(1)).alias("characters"), F.count_distinct("doc_id").alias("documents"))


@query(f"""
WITH w AS (SELECT doc_id, unnest(list_distinct({_WORDS.format("text")})) AS term FROM documents),
f AS (SELECT term, count(*) AS df FROM w GROUP BY term)
SELECT term, df, round(greatest(0.25, least(1.0, 0.9 * 0.98 / greatest(1.0, log2(df + 1)))), 6) AS weight FROM f""")
def document_frequency_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(tx.words(F.col("text")))).alias("term"))
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counted.withColumn("weight", F.round(tx.term_weight(F.lit(0.9), F.lit(0.98), F.lit(1.0), F.col("df")), 6))


@query(r"""
SELECT doc_id, trim(regexp_replace(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^a-z0-9]+', ' ', 'g')) AS term FROM documents""")
def accent_fold_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.accent_folded(F.col("text")).alias("term"))


@query(r"""
WITH d AS (SELECT p_partkey AS entity_id, regexp_extract_all(lower(p_name || ' ' || p_type), '[\p{L}\p{N}][\p{L}\p{N}\p{M}]*') AS t FROM part),
q AS (SELECT min(p_partkey) AS query_id, min(p_partkey) AS target, list_distinct(regexp_extract_all(lower(arg_min(p_name || ' ' || p_type, p_partkey)), '[\p{L}\p{N}][\p{L}\p{N}\p{M}]*')) AS t FROM part GROUP BY p_brand),
f AS (SELECT count(*) AS n, avg(len(t)) AS l FROM d),
p AS (SELECT term, entity_id, count(*) AS tf, any_value(len) AS len FROM (SELECT entity_id, len(t) AS len, unnest(t) AS term FROM d) GROUP BY term, entity_id),
i AS (SELECT term, CASE WHEN ln(((SELECT n FROM f) - count(*) + 0.5) / (count(*) + 0.5)) > 0 THEN ln(((SELECT n FROM f) - count(*) + 0.5) / (count(*) + 0.5)) ELSE 1e-6 END AS idf FROM p GROUP BY term),
a AS (SELECT query_id, unnest(t) AS term FROM q),
s AS (SELECT query_id, entity_id, round(-sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / (SELECT l FROM f)))), 6) AS relevance FROM a JOIN p USING (term) JOIN i USING (term) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance, entity_id) AS rank FROM s)
SELECT q.query_id, r.rank::INTEGER AS rank FROM q LEFT JOIN r ON q.query_id = r.query_id AND q.target = r.entity_id AND r.rank <= 10""")
def retrieval_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    text = F.concat_ws(" ", "p_name", "p_type")
    docs = parts.select(F.col("p_partkey").alias("entity_id"), text.alias("text"))
    # the first part of each brand is asked for by its own words
    firsts = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("query_id"), F.min_by(text, "p_partkey").alias("query"))
    asked = firsts.select("query_id", "query", F.col("query_id").alias("target"))
    return retrieval.target_ranks(docs, asked, stemmed=False)
