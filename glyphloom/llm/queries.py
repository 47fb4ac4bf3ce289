"""The registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.llm import chat_format, fingerprints, language_id, lm_scoring, mixing, near_dedup, packing, quality, token_counts, topk_search

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), carry=("doc_id",))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok").alias("text")
    turns = [F.struct(F.lit(k).cast("bigint").alias("turn"), F.lit(role).alias("role"), said) for k, role in enumerate(("user", "assistant"))]
    more = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.explode(F.array(*turns)).alias("t")).select("conv_id", "t.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.conversation_digests(chat_format.format_conversations(rows)).drop("escape_level", "round_trip")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_mixing, op2_token_counts, op3_near_dedup, op4_packing, op5_chat_format, op6_lm_scoring, op7_quality, op8_topk, op9_fingerprints, op10_language_id)
    return {f.__name__: f for f in own}


_WORD = r"[^\x20\x09-\x0D]+"

_OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 9))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS place
  FROM d GROUP BY source),
w AS (SELECT *, ((place - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER e, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0.0)) AS level,
         cap / weight AS ratio
  FROM w WINDOW e AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, coalesce(least(cap, weight * (SELECT arg_min(level, (ratio, place)) FROM l WHERE level * weight <= cap)), cap) AS target
  FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM t),
j AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.times, greatest(0.0, b.target - b.times * b.source_size) AS budget, b.source, d.h
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
r AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY source, h) AS own
  FROM j),
x AS (
  SELECT *, CASE WHEN upto <= budget THEN 1
                 WHEN upto - own <= budget AND own - (budget - upto + own) < (budget - upto + own) THEN 1 ELSE 0 END AS extra
  FROM r)
SELECT doc_id, size, source_size::BIGINT AS source_size, target::DOUBLE AS target, ((times + extra) * size)::BIGINT AS taken FROM x
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP3 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}'), []) AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * k >= 80 * (na + nb - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c ON s.doc_id = c.a
"""

_OP5 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
k AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\#\#\#'), '</turn>', '<\/turn>') AS escaped,
         regexp_matches(text, '(?s)\\.') OR contains(text || ' ', '</turn>' || chr(10)) AS conflict
  FROM r),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         bool_or(conflict) AS escape,
         sum(length(role) + length(text) + 15) AS plain, sum(length(role) + length(escaped) + 15) AS careful
  FROM k GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       (CASE WHEN escape THEN careful ELSE plain END)::BIGINT AS formatted_chars
FROM c
"""

_OP8 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": _OP1, "op3_near_dedup": _OP3, "op5_chat_format": _OP5, "op8_topk": _OP8}
