"""Selection of an entity corpus: groups, scores, tiers, ranks, exploration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphloom.functions.text import popularity_score

# Fixed values of the scoring.
GROUP_SCORES = {"symbol": 9000, "punctuation": 8500, "number": 7500, "separator": 7000, "mark": 6500, "letter": 2000, "other": 0}
FAILURE_SCORE, FAILURE_PER_COUNT, FAILURE_PER_SEVERITY = 1_000_000, 20_000, 5_000
SEED_SCORE, POPULAR_SCORE, VISUAL_BLOCK_SCORE, PREFERRED_LETTER_SCORE, ALIAS_GAP_SCORE = 900_000, 20_000, 4_000, 3_000, 150
SEQUENCE_SCORE, DEFAULT_TIER, EXPLORATION_SHARE = 30_000, 5, 0.1


def general_group(char: Column) -> Column:
    """Group of a character by its general category."""
    ladder = (("letter", "L"), ("mark", "M"), ("number", "N"), ("punctuation", "P"), ("symbol", "S"), ("separator", "Z"))
    out = F.when(char.isNull(), "other")
    for name, category in ladder:
        out = out.when(char.rlike(rf"^\p{{{category}}}"), name)
    return out.otherwise("other")


def group_score(group: Column) -> Column:
    return F.coalesce(F.create_map(*[x for k, v in GROUP_SCORES.items() for x in (F.lit(k), F.lit(v))])[group], F.lit(0))


def scored(entities: DataFrame) -> DataFrame:
    """selection_score, selection_tier and selection_reasons.

    Reads group, popularity, failure_count, severity, seeded, visual_block, preferred_letter, has_alias, is_sequence;
    nulls count as absent.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    failed = n("failure_count") > 0
    popular = n("popularity") > 0
    score = (
        F.when(yes("is_sequence"), SEQUENCE_SCORE).otherwise(group_score(F.col("group")))
        + F.when(failed, FAILURE_SCORE + FAILURE_PER_COUNT * n("failure_count") + FAILURE_PER_SEVERITY * n("severity")).otherwise(0)
        + F.when(yes("seeded"), SEED_SCORE).otherwise(0)
        + F.when(popular, POPULAR_SCORE + popularity_score(n("popularity"))).otherwise(0)
        + F.when(yes("visual_block"), VISUAL_BLOCK_SCORE).otherwise(0)
        + F.when(yes("preferred_letter"), PREFERRED_LETTER_SCORE).otherwise(0)
        + F.when(~yes("has_alias"), ALIAS_GAP_SCORE).otherwise(0)
    )
    tier = F.least(
        F.when(failed | yes("seeded"), 0).otherwise(DEFAULT_TIER),
        F.when(popular | yes("visual_block") | yes("is_sequence"), 2).otherwise(DEFAULT_TIER),
        F.when(yes("preferred_letter"), 3).otherwise(DEFAULT_TIER),
    )
    reasons = F.array_compact(
        F.array(
            F.when(failed, "failure"), F.when(yes("seeded"), "seed"), F.when(popular, "popular"), F.when(yes("visual_block"), "visual-block"), F.when(yes("preferred_letter"), "preferred-letter"), F.when(~yes("has_alias"), "alias-gap")
        )
    )
    return entities.withColumn("selection_score", score.cast("long")).withColumn("selection_tier", tier).withColumn("selection_reasons", reasons)


def selection_order(group_order: list[str], key: str = "key") -> list[Column]:
    """Generation group, tier, score, kind, then keys as numbers before keys as text."""
    place = F.coalesce(F.create_map(*[x for k, g in enumerate(group_order) for x in (F.lit(g), F.lit(k))])[F.col("group")], F.lit(len(group_order)))
    number = F.col(key).try_cast("bigint")
    return [place, F.col("selection_tier"), F.col("selection_score").desc(), F.col("kind"), number.asc_nulls_last(), F.col(key)]


def selected(entities: DataFrame, order: list[Column], target: int) -> DataFrame:
    """The first ``target`` by the order, never fewer than all of tier 0, with ranks from 1.

    Priority rows come first within the limit; only the ``target`` + priority rows are numbered in one task.
    """
    priority = entities.where("selection_tier = 0").count()
    size = max(target, priority)
    best = entities.orderBy((F.col("selection_tier") > 0), *order).limit(size)
    return best.withColumn("selection_rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)))


def failure_rollup(failures: DataFrame) -> DataFrame:
    """(key, count, severity, roles) over the target and competitor keys of all failures."""
    roles = F.concat(
        F.array(F.struct(F.col("target_key").alias("key"), F.lit("target").alias("role"))),
        F.transform(F.coalesce("thief_keys", F.array().cast("array<string>")), lambda k: F.struct(k.alias("key"), F.lit("competitor").alias("role"))),
    )
    exploded = failures.select(F.explode(roles).alias("r"), F.greatest(F.lit(1), F.coalesce("count", F.lit(1))).alias("count"), F.least(F.lit(5), F.greatest(F.lit(1), F.coalesce("severity", F.lit(1)))).alias("severity"))
    return exploded.where("r.key is not null").groupBy(F.col("r.key").alias("key")).agg(F.sum("count").alias("count"), F.max("severity").alias("severity"), F.array_sort(F.collect_set("r.role")).alias("roles"))


def unique_visual(entities: DataFrame, key: str, visual: str, order: str) -> DataFrame:
    """The first of each id, then the first of each visual key, in order."""
    by_id = entities.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(order))).where("_r = 1")
    return by_id.withColumn("_r", F.row_number().over(W.partitionBy(visual).orderBy(order))).where("_r = 1").drop("_r")


def visual_key(hex_sequence: Column, mode: Column) -> Column:
    """Render mode and code points without presentation selectors; of selectors alone the first stays.

    No sequence, no key; a mode that is null counts as standalone.
    """
    codes = F.split(F.lower(hex_sequence), "[- ]")
    selector = lambda h: h.isin("fe0e", "fe0f")
    kept = F.filter(codes, lambda h, k: ~selector(h) | ((k == 0) & F.forall(codes, selector)))
    return F.concat(F.coalesce(mode, F.lit("standalone")), F.lit(":"), F.array_join(kept, "-"))
