"""Corpus planning from end to end: eligible characters and sequences, scores, priority groups, exploration, ranks; cohorts, seeds and failure edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphloom.operators import sampling, selection
from glyphloom.operators.claims import GENERATION_GROUPS, generation_group
from glyphloom.operators.dedup import first_wins

# Parts of the names of blocks, and the groups that are useful as they are.
HARD_EXCLUDED_BLOCKS = ("private-use", "surrogate", "variation-selectors", "tags", "specials", "unassigned")
PREFERRED_LETTER_BLOCKS = (
    "basic-latin", "latin-", "ipa-extensions", "phonetic-extensions", "spacing-modifier", "greek", "cyrillic", "armenian", "georgian", "hebrew", "arabic-supplement", "devanagari", "bengali", "gurmukhi",
    "gujarati", "oriya", "tamil", "telugu", "kannada", "malayalam", "sinhala", "thai", "lao", "tibetan", "myanmar", "ethiopic", "cherokee", "hiragana", "katakana", "hangul-jamo", "bopomofo", "letterlike",
    "alphabetic-presentation", "halfwidth-and-fullwidth",
)
PREFERRED_LETTER_ENDINGS = ("arabic",)
VISUAL_BLOCKS = (
    "arrow", "symbol", "dingbat", "shape", "pictograph", "technical", "operator", "currency", "punctuation", "alchemical", "chess", "card", "domino", "mahjong", "musical", "braille", "box-drawing",
    "block-elements", "geometric", "ornamental",
)
USEFUL_GROUPS = ("mark", "number", "punctuation", "symbol", "separator")
FAILURE_STRENGTH = 1.0


def _has(block: Column, parts: tuple[str, ...], endings: tuple[str, ...] = ()) -> Column:
    low = F.lower(F.coalesce(block, F.lit("")))
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(low, F.lit(p))
    for e in endings:
        out = out | F.endswith(low, F.lit(e))
    return out


def entity_key(kind: Column, key: Column) -> Column:
    return F.concat(kind, F.lit(":"), key)


def characters_to_plan(characters: DataFrame) -> DataFrame:
    """Characters (code_point, hex, name, category_key, character, popularity, synonyms) with what eligibility and scores read."""
    block, group = F.col("category_key"), selection.general_group(F.col("character"))
    combining = (group == "mark") | F.col("name").rlike(r"(?i)\bCOMBINING\b")
    return characters.select(
        F.lit("character").alias("kind"),
        F.col("code_point").cast("string").alias("target_key"),
        F.lower("hex").alias("hex"),
        "name",
        "character",
        "category_key",
        "popularity",
        "synonyms",
        group.alias("group"),
        _has(block, HARD_EXCLUDED_BLOCKS).alias("hard_excluded"),
        _has(block, VISUAL_BLOCKS).alias("visual_block"),
        ((group == "letter") & _has(block, PREFERRED_LETTER_BLOCKS, PREFERRED_LETTER_ENDINGS)).alias("preferred_letter"),
        group.isin(*USEFUL_GROUPS).alias("useful"),
        F.when(combining, "combining").otherwise("standalone").alias("render_mode"),
        F.lit(False).alias("is_sequence"),
    )


def sequences_to_plan(sequences: DataFrame, characters: DataFrame) -> DataFrame:
    """Emoji sequences (sequence_key, name, emoji, category_key, popularity, synonyms), without those that are a planned
    character, alone or with a variation selector."""
    key = F.lower(F.regexp_replace("sequence_key", r"[\s_]+", "-"))
    base = F.regexp_extract(key, r"^0*([0-9a-f]+)(?:-fe0[ef])?$", 1)
    known = characters.select(F.regexp_replace(F.lower("hex"), "^0+", "").alias("_base")).distinct()
    rows = sequences.select(
        F.lit("emoji_sequence").alias("kind"),
        key.alias("target_key"),
        key.alias("hex"),
        "name",
        F.col("emoji").alias("character"),
        "category_key",
        "popularity",
        "synonyms",
        F.lit("emoji_sequence").alias("group"),
        *[F.lit(False).alias(c) for c in ("hard_excluded", "visual_block", "preferred_letter", "useful")],
        F.lit("standalone").alias("render_mode"),
        F.lit(True).alias("is_sequence"),
        base.alias("_base"),
    )
    return rows.join(known, "_base", "left_anti").drop("_base")


def with_failures(entities: DataFrame, failures: DataFrame) -> DataFrame:
    """Failure counts by ``kind:key``, else by the bare key (``selection.failure_rollup``: key, count, severity)."""
    named = failures.select("key", "count", "severity")
    own = named.select(F.col("key").alias("_full"), F.col("count").alias("_c"), F.col("severity").alias("_s"))
    bare = named.select(F.col("key").alias("_bare"), F.col("count").alias("_c2"), F.col("severity").alias("_s2"))
    full = entities.withColumn("_id", entity_key(F.col("kind"), F.col("target_key")))
    joined = full.join(own, F.col("_id") == F.col("_full"), "left").join(bare, F.col("target_key") == F.col("_bare"), "left")
    # the whole row of one of the two, never a mixture
    pick = lambda a, b: F.when(F.col("_full").isNotNull(), F.col(a)).otherwise(F.col(b))
    return joined.withColumns({"failure_count": pick("_c", "_c2"), "severity": pick("_s", "_s2")}).drop("_id", "_full", "_c", "_s", "_bare", "_c2", "_s2")


def with_scores(entities: DataFrame, seeds: DataFrame) -> DataFrame:
    """``selection.scored`` with seeds (key: ``kind:key`` or bare), and tier 2 for groups that are useful as they are."""
    listed = seeds.select(F.col("key").alias("_seed")).distinct()
    full = entities.withColumn("_id", entity_key(F.col("kind"), F.col("target_key")))
    joined = full.join(listed.withColumnRenamed("_seed", "_id").withColumn("_a", F.lit(True)), "_id", "left").join(listed.withColumnRenamed("_seed", "target_key").withColumn("_b", F.lit(True)), "target_key", "left")
    seeded = joined.withColumn("seeded", F.coalesce("_a", "_b", F.lit(False))).drop("_a", "_b", "_id")
    known = seeded.withColumn("has_alias", F.coalesce(F.trim("synonyms") != "", F.lit(False))).withColumn("key", entity_key(F.col("kind"), F.col("target_key")))
    found = selection.scored(known)
    return found.withColumn("selection_tier", F.when(F.col("useful"), F.least(F.lit(2), F.col("selection_tier"))).otherwise(F.col("selection_tier")))


def planned(entities: DataFrame, target: int, share: float = selection.EXPLORATION_SHARE) -> DataFrame:
    """The corpus: all of the priority groups, then the best others, then a fill by categories in turn; ranks from 1.

    ``entities``: what ``with_scores`` gives.  Excluded characters come in by a failure or seed only.  The target limits
    what isn't priority; sizes come to the driver as one row.
    """
    forced = (F.coalesce("failure_count", F.lit(0)) > 0) | F.col("seeded")
    pool = entities.where(~F.col("hard_excluded") | forced)
    pool = pool.withColumnRenamed("group", "general_category")
    pool = pool.withColumn("group", generation_group(F.col("character"), F.col("name"), F.col("category_key"), F.col("is_sequence")))
    order = selection.selection_order(list(GENERATION_GROUPS), "target_key")
    priority = pool.where(F.col("group") != GENERATION_GROUPS[-1])
    rest = pool.where(F.col("group") == GENERATION_GROUPS[-1])
    sizes = pool.agg(F.count_if(F.col("group") != GENERATION_GROUPS[-1]).alias("priority"), F.count(F.lit(1)).alias("all")).first()
    slots = max(0, target - sizes["priority"])
    exploring = int(slots * share)
    best = rest.orderBy(*order).limit(slots - exploring)
    left = rest.join(best.select("key"), "key", "left_anti")
    ranked = left.withColumn("_place", F.row_number().over(W.partitionBy("category_key").orderBy(*order)))
    explored = sampling.rotating_fill(ranked.where(F.col("_place") <= exploring).select("category_key", "_place", "key"), "category_key", ["_place"], exploring).select("key") if exploring else left.select("key").limit(0)
    added = rest.join(explored, "key", "left_semi").withColumn("selection_reasons", F.concat("selection_reasons", F.array(F.lit("category-exploration"))))
    whole = priority.unionByName(best).unionByName(added)
    labelled = whole.withColumn("selection_reasons", F.concat(F.array(F.concat(F.lit("generation-group:"), F.col("group"))), "selection_reasons"))
    return labelled.withColumn("selection_rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)))


def cohort(characters: DataFrame, family: str | None = None, code_points: list[int] | None = None) -> DataFrame:
    """Characters (code_point, family) of one family, or the listed ones, all of which must be there."""
    if bool(family) == bool(code_points):
        raise ValueError("choose a family or code points")
    own = characters.where(F.col("family") == family) if family else characters.where(F.col("code_point").isin(*code_points))
    found = own.count()
    if not found or code_points and found != len(set(code_points)):
        raise ValueError("no members, or some requested code points are missing")
    return own


def seed_targets(seeds: DataFrame, reference: DataFrame) -> DataFrame:
    """Seed targets (hex, fallback_name) as entities, with the reference's name and character where it has them."""
    sequence = F.contains("hex", F.lit("-"))
    key = F.when(sequence, F.lower("hex")).otherwise(F.conv("hex", 16, 10))
    named = seeds.select(F.when(sequence, "emoji_sequence").otherwise("character").alias("kind"), key.alias("target_key"), "hex", "fallback_name")
    joined = named.join(reference.select("target_key", F.col("name").alias("_name"), "character"), "target_key", "left")
    return joined.select("kind", "target_key", "hex", F.coalesce("_name", "fallback_name").alias("name"), F.coalesce("character", F.lit("")).alias("character"), F.lit(9999).alias("popularity"), F.lit(0).alias("priority"))


def failure_edges(pairs: DataFrame, selected: DataFrame) -> DataFrame:
    """Edges of failure reports (query, victim, thief as hex keys) both ends of which are selected."""

    def entity(hex_key: str) -> Column:
        sequence = F.contains(hex_key, F.lit("-"))
        return F.when(sequence, F.concat(F.lit("emoji_sequence:"), F.lower(hex_key))).otherwise(F.concat(F.lit("character:"), F.conv(hex_key, 16, 10)))

    ends = pairs.select(entity("victim").alias("a"), entity("thief").alias("b"), F.concat(F.lit("failure-query:"), F.col("query")).alias("reason"), F.lit(FAILURE_STRENGTH).alias("strength"))
    known = selected.select("key").distinct()
    return ends.join(known.withColumnRenamed("key", "a"), "a", "left_semi").join(known.withColumnRenamed("key", "b"), "b", "left_semi").select("a", "b", "reason", "strength")


def synonym_backfill(terms: DataFrame) -> DataFrame:
    """(target_key, synonyms): the terms of each target (term, normalized, ordinal), the first spelling of each, joined in order."""
    once = first_wins(terms.where(F.col("normalized") != ""), ["target_key", "normalized"], [F.col("ordinal"), F.col("term")])
    kept = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "term"))), lambda x: x["term"])
    return once.groupBy("target_key").agg(F.array_join(kept, "; ").alias("synonyms"))
