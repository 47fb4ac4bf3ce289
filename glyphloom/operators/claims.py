"""Claims and queries of entities: phrase rules, canonical claims, verification plans, search terms, calibration."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphloom.functions.text import clamp, normalised_term, term_weight
from glyphloom.operators.dedup import first_wins

# Statuses, thresholds and weights.
ACCEPTED = ("verified", "platform_specific")
MIN_CONFIDENCE, MIN_PLATFORM_CONFIDENCE, MOST_TARGETS, MIN_AGREEMENT = 0.62, 0.78, 12, 0.7
FAMILY_WEIGHTS = {"identity": 1.0, "colloquial": 0.98, "usage": 0.93, "cultural": 0.9, "technical": 0.9, "visual": 0.86, "constraint": 0.82}
OTHER_FAMILY_WEIGHT, PLATFORM_SCOPE, MIN_ALIASES = 0.8, 0.82, 3
GENERIC = ("character", "glyph", "icon", "letter", "mark", "sign", "symbol", "unicode")
OPPOSITES = (
    (("acute",), ("grave",)),
    (("left", "leftward", "leftwards"), ("right", "rightward", "rightwards")),
    (("up", "upward", "upwards"), ("down", "downward", "downwards")),
    (("above",), ("below",)),
    (("clockwise",), ("anticlockwise", "counterclockwise")),
    (("horizontal",), ("vertical",)),
)
LOW_INFORMATION = (
    "zero one two three four five six seven eight nine ten single multiple component components element elements object objects shape shapes "
    "glyph icon mark symbol part parts solid filled fill outline outlined hollow gradient shaded shading "
    "black white gray grey red orange yellow green blue purple pink brown tan gold golden dark light pale bright medium background foreground"
).split()
SLOTS = ("overall_form", "distinctive_feature")
GENERATION_GROUPS = ("arrows", "formatting", "punctuation", "special-symbols", "emoji", "everything-else")


def normalised_phrase(term: Column, most_words: int = 10, most_chars: int = 100) -> Column:
    """A normalised term that can stand as a phrase, else null: 2 characters at least, bounded, not generic."""
    size = F.length(term).between(2, most_chars) & (F.size(F.split(term, " ")) <= most_words)
    return F.when(size & ~term.isin(*GENERIC), term)


def _sides(words: Column) -> Column:
    """The direction words among ``words`` as numbers: one for each axis, its opposite negative."""
    number = [x for k, pair in enumerate(OPPOSITES, 1) for sign, side in zip((1, -1), pair, strict=True) for w in side for x in (F.lit(w), F.lit(sign * k))]
    return F.array_distinct(F.filter(F.transform(F.split(words, " "), lambda w: F.try_element_at(F.create_map(*number), w)), lambda n: n.isNotNull()))


def contradicts(name: Column, phrase: Column) -> Column:
    """Does a normalised phrase point the other way on an axis on which the normalised name points one way only?"""
    own = _sides(name)
    one_way = F.filter(own, lambda n: ~F.array_contains(own, -n))
    return F.arrays_overlap(_sides(phrase), F.transform(one_way, lambda n: -n))


def useful_phrase(slot: Column, phrase: Column) -> Column:
    """Two informative tokens at least, in one of the slots that describe form."""
    tokens = F.filter(F.split(phrase, " "), lambda t: (t != "") & ~t.rlike("^[0-9]+$") & ~t.isin(*LOW_INFORMATION))
    return slot.isin(*SLOTS) & (F.size(tokens) >= 2)


def contrastive(queries: DataFrame) -> Column:
    return (F.size("must_beat") > 0) | (F.size("must_not") > 0)


def skipped_adjudications(queries: DataFrame) -> DataFrame:
    """Queries that ask for no contrast are skipped, the others stay as they are."""
    return queries.withColumn("status", F.when(~contrastive(queries), "skipped").otherwise(F.col("status")))


def generation_group(glyph: Column, name: Column, block: Column, is_sequence: Column) -> Column:
    """The group in which an entity is generated; tests are in this order, sorting follows GENERATION_GROUPS.  A null counts as empty."""
    glyph, name, block = (F.coalesce(c, F.lit("")) for c in (glyph, name, block))
    pictograph = block.rlike(r"(?i)emoji|emoticon") | is_sequence
    return (
        F.when(block.rlike(r"(?i)arrow") | name.rlike(r"(?i)\b(?:ARROWS?|ARROWHEADS?|HARPOONS?)\b"), "arrows")
        .when(glyph.rlike(r"^[\p{Cf}\p{Cc}\p{Z}]+$") | block.rlike(r"(?i)box-drawing|block-elements|geometric-shapes|control-pictures|dingbat") | name.rlike(r"(?i)\b(?:BULLET|PILCROW|SECTION SIGN|ORNAMENT|FLEURON)\b"), "formatting")
        .when(glyph.rlike(r"^\p{P}+$") | block.rlike(r"(?i)punctuation"), "punctuation")
        .when(pictograph, "emoji")
        .when(glyph.rlike(r"^\p{S}+$") | block.rlike(r"(?i)miscellaneous-technical|letterlike-symbols|mathematical|currency-symbols"), "special-symbols")
        .otherwise("everything-else")
    )


def current_only(rows: DataFrame, versions: list[str], column: str = "prompt_version") -> DataFrame:
    return rows.where(F.col(column).isin(*versions))


def canonical_claims(claims: DataFrame) -> DataFrame:
    """Claims with ``duplicate``: false for the one that stands for its phrase (accepted first, then confidence, then id)."""
    order = W.partitionBy("entity_id", "normalized_phrase").orderBy(F.col("status").isin(*ACCEPTED).desc(), F.col("confidence").desc(), "claim_id")
    return claims.withColumn("duplicate", F.row_number().over(order) > 1)


def verification_plan(claims: DataFrame, retained: list[str], vendors: int) -> DataFrame:
    """What verification does with each claim: ``reject`` (duplicate), ``retain`` (freshly accepted), ``verify`` or ``none``.

    Blind wording counts only with the support of all vendors.
    """
    eligible = claims.where((F.col("source_stage") != "blind_ground") | (F.col("vendor_support") >= vendors))
    accepted = F.col("status").isin(*ACCEPTED)
    fresh = accepted & F.coalesce(F.col("verifier_version").isin(*retained), F.lit(False))
    action = F.when(F.col("duplicate"), "reject").when(fresh, "retain").when(F.col("status").isin("proposed", "contested") | accepted, "verify").otherwise("none")
    return canonical_claims(eligible).withColumn("action", action)


def verification_outcome(plan: DataFrame) -> DataFrame:
    """Entities with nothing to verify: passed if enough aliases are retained, else failed; others are ready."""
    by = plan.groupBy("entity_id").agg(F.count_if(F.col("action") == "verify").alias("open"), F.count_if(F.col("action") == "retain").alias("kept"), F.count_if(~F.col("duplicate")).alias("canonical"))
    needed = F.greatest(F.lit(1), F.least(F.lit(MIN_ALIASES), F.col("canonical")))
    return by.select("entity_id", "open", "kept", F.when(F.col("open") > 0, "ready").when(F.col("kept") >= needed, "passed").otherwise("failed").alias("outcome"))


def synthesis_claims(claims: DataFrame, queries: DataFrame, low: int = 2) -> DataFrame:
    """Accepted claims that fewer than ``low`` queries use yet."""
    used = queries.select(F.explode("claim_ids").alias("claim_id")).groupBy("claim_id").agg(F.count(F.lit(1)).alias("used"))
    accepted = canonical_claims(claims.where(F.col("status").isin(*ACCEPTED))).where("not duplicate").drop("duplicate")
    return accepted.join(used, "claim_id", "left").where(F.coalesce("used", F.lit(0)) < low)


def rewrite_context(claims: DataFrame, accepted: int = 6, repair: int = 8) -> DataFrame:
    """Per entity the best accepted claims, those to repair, and how many aliases are missing."""
    rank = W.partitionBy("entity_id", F.col("status").isin(*ACCEPTED)).orderBy(F.col("confidence").desc(), "claim_id")
    ranked = claims.withColumn("_r", F.row_number().over(rank)).withColumn("_ok", F.col("status").isin(*ACCEPTED))
    pick = lambda ok, n: F.array_sort(F.collect_list(F.when((F.col("_ok") == ok) & (F.col("_r") <= n), F.struct(F.col("_r").alias("r"), "phrase"))))
    by = ranked.groupBy("entity_id").agg(pick(True, accepted).alias("a"), pick(False, repair).alias("b"), F.count_if(F.col("_ok")).alias("n"))
    return by.select("entity_id", F.col("a.phrase").alias("accepted"), F.col("b.phrase").alias("repair"), F.greatest(F.lit(0), MIN_ALIASES - F.col("n")).alias("gap"))


def recovery(votes: DataFrame) -> DataFrame:
    """A recovery passes if every vote picked its target."""
    return votes.groupBy("entity_id").agg(F.bool_and(F.col("picked_entity_id").eqNullSafe(F.col("entity_id"))).alias("passed"), F.count(F.lit(1)).alias("votes"))


def adjudication_cases(queries: DataFrame, neighbours: DataFrame, visual: DataFrame, most: int = 8) -> DataFrame:
    """(query_id, candidate, place): the target, then requested rivals, then neighbours, one of each look, at most ``most``.

    Cases with fewer than two candidates are left out.
    """
    target = queries.select("query_id", F.col("entity_id").alias("candidate"), F.lit(0).alias("part"), F.lit(0).alias("at"))
    asked = queries.select("query_id", F.posexplode(F.concat("must_beat", "must_not")).alias("at", "candidate")).select("query_id", "candidate", F.lit(1).alias("part"), "at")
    near = queries.select("query_id", F.col("entity_id").alias("id")).join(neighbours, "id").select("query_id", F.col("other").alias("candidate"), F.lit(2).alias("part"), F.col("rank").alias("at"))
    everyone = target.unionByName(asked).unionByName(near).join(visual.withColumnRenamed("id", "candidate"), "candidate")
    by_id = first_wins(everyone, ["query_id", "candidate"], [F.col("part"), F.col("at")])
    once = first_wins(by_id, ["query_id", "visual_key"], [F.col("part"), F.col("at")])
    placed = once.withColumn("place", F.row_number().over(W.partitionBy("query_id").orderBy("part", "at"))).withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("query_id")))
    return placed.where((F.col("place") <= most) & (F.col("_n") >= 2)).select("query_id", "candidate", "place")


def search_terms(claims: DataFrame, adjudications: DataFrame) -> DataFrame:
    """(target_kind, target_key, normalized_term, term, weight, provenance), the heaviest of each term.

    ``claims``: target_kind, target_key, entity_id, family, phrase, normalized_phrase, confidence, status;
    ``adjudications``: target_kind, target_key, query, agreement.
    """
    targets = claims.groupBy("normalized_phrase").agg(F.count_distinct("entity_id").alias("_df"))
    weights = F.coalesce(F.create_map(*[x for k, v in FAMILY_WEIGHTS.items() for x in (F.lit(k), F.lit(v))])[F.col("family")], F.lit(OTHER_FAMILY_WEIGHT))
    platform = F.col("status") == "platform_specific"
    kept = claims.join(targets, "normalized_phrase").where((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("_df") <= MOST_TARGETS) & ~(platform & (F.col("confidence") < MIN_PLATFORM_CONFIDENCE)))
    from_claims = kept.select(
        "target_kind", "target_key", F.col("normalized_phrase").alias("normalized_term"), F.col("phrase").alias("term"),
        term_weight(F.col("confidence"), weights, F.when(platform, PLATFORM_SCOPE).otherwise(1.0), F.col("_df")).alias("weight"), F.lit("verified-claim").alias("provenance"),
    )
    won = adjudications.where(F.col("agreement") >= MIN_AGREEMENT).withColumn("normalized_term", normalised_term("query")).where("normalized_term <> ''")
    from_votes = won.select("target_kind", "target_key", "normalized_term", F.col("query").alias("term"), clamp(F.col("agreement") * 1.05, 0.5, 1.05).alias("weight"), F.lit("cluster-adjudication").alias("provenance"))
    both = from_claims.unionByName(from_votes)
    return first_wins(both, ["target_kind", "target_key", "normalized_term"], [F.col("weight").desc(), F.col("provenance").desc(), F.col("term")])


def alias_report(entities: DataFrame, claims: DataFrame) -> DataFrame:
    """One row: totals, coverage and the zero-filled aliases per entity at four places."""
    from glyphloom.operators.reports import floor_percentiles, rate

    per = claims.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    filled = entities.select("entity_id").join(per, "entity_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    places = floor_percentiles(filled, "n", [0.0, 0.5, 0.9, 1.0]).first()
    totals = filled.agg(F.count(F.lit(1)).alias("entities"), F.sum("n").alias("claims"), F.count_if(F.col("n") > 0).alias("covered"))
    return totals.select("entities", "claims", "covered", rate(F.col("covered"), F.col("entities")).alias("coverage_rate"), *[F.lit(v).alias(k) for k, v in places.asDict().items()])


def related_cohort(candidates: DataFrame, first: dict, neighbours: list[str], size: int) -> DataFrame:
    """The candidates nearest to the first one: neighbours, same category, same general category, same tier; ties in order."""
    affinity = (
        F.when(F.col("entity_id").isin(*neighbours) if neighbours else F.lit(False), 100).otherwise(0)
        + F.when(F.col("category_key").eqNullSafe(F.lit(first["category_key"])), 40).otherwise(0)
        + F.when(F.col("general_category").eqNullSafe(F.lit(first["general_category"])), 10).otherwise(0)
        + F.when(F.col("selection_tier").eqNullSafe(F.lit(first["selection_tier"])), 2).otherwise(0)
    )
    return candidates.withColumn("affinity", affinity).orderBy(F.col("affinity").desc(), "ordinal").limit(size)


def packed_signals(signals: Column, most: int = 6) -> Column:
    """At most ``most`` signals: the first of every rule, then the others, each in order."""
    numbered = F.transform(signals, lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    rules = F.transform(signals, lambda s: s["rule"])
    firsts = F.filter(numbered, lambda x: F.array_position(rules, x["s"]["rule"]) == x["i"] + 1)
    rest = F.filter(numbered, lambda x: F.array_position(rules, x["s"]["rule"]) != x["i"] + 1)
    return F.transform(F.slice(F.concat(firsts, rest), 1, most), lambda x: x["s"])


def shuffled(values: list, seed: str) -> list:
    """A permutation that a seed fixes: Fisher-Yates from the end, fed by a linear congruential generator."""
    out, state = list(values), int(hashlib.sha256(f'"{seed}"'.encode()).hexdigest()[:8], 16)
    for left in range(len(out), 1, -1):
        state = (state * 1664525 + 1013904223) % (1 << 32)
        k = state * left >> 32
        out[left - 1], out[k] = out[k], out[left - 1]
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def seeded_shuffle(values: pd.Series, seed: pd.Series) -> pd.Series:
    return pd.Series([None if v is None else shuffled(list(v), s or "") for v, s in zip(values, seed, strict=True)])


def calibration(expected: DataFrame, responses: DataFrame) -> DataFrame:
    """One row: false accepts and rejects against expected verdicts, with their opportunities, rates and completeness.

    ``expected``: (case_id, path, good boolean); ``responses``: (case_id, path, accepted boolean).
    """
    joined = expected.join(responses.withColumn("_seen", F.lit(True)), ["case_id", "path"], "left")
    good, accepted, seen = F.col("good"), F.coalesce("accepted", F.lit(False)), F.col("_seen").isNotNull()
    out = joined.agg(
        F.count_if(seen & good).alias("expected_good"),
        F.count_if(seen & good & ~accepted).alias("false_rejects"),
        F.count_if(seen & ~good).alias("expected_bad"),
        F.count_if(seen & ~good & accepted).alias("false_accepts"),
        F.bool_and(seen).alias("complete"),
    )
    return out.select("*", F.try_divide("false_rejects", "expected_good").alias("false_reject_rate"), F.try_divide("false_accepts", "expected_bad").alias("false_accept_rate"))


def sampled_families(rows: DataFrame, family: str, key: str, seed: str, size: int) -> DataFrame:
    """A fixed sample without replacement of each family, distinct by key."""
    once = rows.dropDuplicates([family, key]).withColumn("_h", F.sha2(F.concat(F.lit(seed + ":"), F.col(key).cast("string")), 256))
    return once.withColumn("_r", F.row_number().over(W.partitionBy(family).orderBy("_h", key))).where(F.col("_r") <= size).drop("_h", "_r")


def frozen_holdout(entities: DataFrame, existing: DataFrame | None, stratum: str, size: int, seed: str) -> DataFrame:
    """Evaluation holdout: drawn once by strata in turn; once it exists it never changes."""
    if existing is not None and not existing.isEmpty():
        return existing
    rank = F.sha2(F.concat(F.lit(seed + ":"), F.col("entity_id")), 256)
    ranked = entities.withColumn("_r", F.row_number().over(W.partitionBy(stratum).orderBy(rank, "entity_id")))
    return ranked.where(F.col("_r") <= size).orderBy("_r", stratum).limit(size).select("entity_id", stratum)
