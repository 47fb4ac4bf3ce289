"""Records: JSON salvage from free text, field contracts, property scopes, embedding text, vocabulary."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds of a record, and the closed lists of its vocabulary.
MOST_NAMES, MOST_PROPERTIES, MOST_VALUES, MOST_CANDIDATES, MOST_SUPPORTS = 16, 12, 6, 40, 4
INTENTS = ("name", "appearance", "meaning", "use")
CONTEXT_LIMIT = 40_000


def json_candidates(text: str | None) -> list:
    """JSON values in a text, best first: fenced blocks if any parse, else balanced parts.

    Of parts that end at one place the innermost stays; longer ones come first, then later ones.
    """
    text = text or ""
    fenced = []
    for m in re.finditer(r"```(?:json)?\s*(.*?)```", text, re.IGNORECASE | re.DOTALL):
        try:
            fenced.append((-len(m[1]), -m.start(), json.loads(m[1].strip())))
        except ValueError:
            pass
    if fenced:
        return [x[2] for x in sorted(fenced, key=lambda x: x[:2])]
    by_end: dict[int, tuple[int, object]] = {}
    decoder = json.JSONDecoder()
    for m in re.finditer(r"[{\[]", text):
        try:
            # one value from here, or the first error in it
            value, end = decoder.raw_decode(text, m.start())
            by_end[end] = (m.start(), value)
        except (ValueError, RecursionError):
            pass
    return [v for _, _, v in sorted(((a - e, -a, v) for e, (a, v) in by_end.items()), key=lambda x: x[:2])]


def matching_json(text: str | None, accepts: Callable[[object], bool]) -> object | None:
    """The best JSON value in a text that a predicate accepts; one that it fails on is passed over."""
    for value in json_candidates(text):
        try:
            if accepts(value):
                return value
        except (KeyError, TypeError, ValueError, IndexError):
            continue
    return None


def salvaged_with(keys: tuple[str, ...]):
    """A pandas UDF: the best JSON object in a text that has all of ``keys``, with sorted keys; null without one."""

    @F.pandas_udf(T.StringType())
    def found(text: pd.Series) -> pd.Series:
        one = lambda t: matching_json(t, lambda v: isinstance(v, dict) and set(keys) <= set(v))
        return text.map(lambda t: None if (v := one(t)) is None else canonical_json(v))

    return found


@F.pandas_udf(T.StringType())
def salvaged_json(text: pd.Series) -> pd.Series:
    """The best JSON value in a text, with sorted keys; null without one."""

    def one(t: str | None) -> str | None:
        found = json_candidates(t)
        return canonical_json(found[0]) if found else None

    return text.map(one)


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def spaced_digest_text(value: object) -> str:
    """The text whose SHA-256 names a value in the mining half: sorted keys, spaced separators."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False)


def text_errors(text: Column, most: int) -> Column:
    """Errors of a required text: missing, untrimmed, empty, too long."""
    return F.array_compact(
        F.array(
            F.when(text.isNull(), "missing"),
            F.when(text != F.trim(text), "untrimmed"),
            F.when(F.trim(text) == "", "empty"),
            F.when(F.length(text) > most, "too long"),
        )
    )


def record_errors(rows: DataFrame) -> DataFrame:
    """Contract errors of records (names array<string>, properties array<struct<key,values,basis,attachments>>)."""
    names, properties = F.col("names"), F.col("properties")
    errors = F.array_compact(
        F.array(
            F.when(F.size(names) > MOST_NAMES, "too many names"),
            F.when(F.size(F.array_distinct(names)) < F.size(names), "repeated name"),
            F.when(F.exists(names, lambda n: (F.trim(n) == "") | (n != F.trim(n))), "untrimmed name"),
            F.when(F.size(properties) > MOST_PROPERTIES, "too many properties"),
            F.when(F.exists(properties, lambda p: F.size(p["values"]) > MOST_VALUES), "too many values"),
            F.when(F.exists(properties, lambda p: ~p["basis"].isin("render", "established")), "unknown basis"),
            F.when(F.exists(properties, lambda p: (p["basis"] == "render") & (F.size(p["attachments"]) == 0)), "render without attachment"),
        )
    )
    return rows.withColumn("errors", errors)


def property_scope(basis: Column, attachments: Column, hashes: Column) -> Column:
    """established, cross_render (every one of several distinct renders is cited) or observed."""
    everything = F.array_distinct(F.array_compact(hashes))
    cited = F.array_distinct(F.array_compact(F.transform(attachments, lambda k: F.try_element_at(hashes, k.cast("int")))))
    return F.when(basis != "render", "established").when((F.size(everything) > 1) & (F.size(cited) == F.size(everything)), "cross_render").otherwise("observed")


def embedding_text(appearance: Column, identity: Column, names: Column, meaning: Column) -> Column:
    known = F.when(F.size(names) > 0, F.concat(F.lit("Also known as: "), F.array_join(names, "; "), F.lit(".")))
    return F.array_join(F.array_distinct(F.array_compact(F.array(F.coalesce(appearance, identity), known, meaning))), "\n")


def facets(properties: Column) -> Column:
    return F.map_from_entries(F.transform(properties, lambda p: F.struct(p["key"], p["values"])))


def unique_renders(renders: DataFrame) -> DataFrame:
    """One render for each ink hash, the first, with all who gave it."""
    return renders.groupBy("entity_id", "hash").agg(F.min_by("render_id", "ordinal").alias("render_id"), F.array_sort(F.collect_set("vendor")).alias("vendors"))


def vocabulary(phrases: DataFrame) -> DataFrame:
    """One row for each (entity, phrase): the first by ordinal, direct if any is direct."""
    first = W.partitionBy("entity_id", "phrase").orderBy((F.col("relevance") == "direct").desc(), "ordinal")
    return phrases.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


def register_counts(phrases: DataFrame, registers: list[str]) -> DataFrame:
    """Phrases of each entity by register, 0 where there are none."""
    return phrases.groupBy("entity_id").agg(*[F.count_if(F.col("register") == r).alias(r) for r in registers])


def intent_candidates(phrases: DataFrame) -> DataFrame:
    """At most one phrase for each meaning or use group that has a direct one; all other intents stay out."""
    kept = phrases.where(F.col("intent").isin("meaning", "use") & (F.col("relevance") == "direct"))
    return kept.withColumn("_r", F.row_number().over(W.partitionBy("entity_id", "group_id").orderBy("ordinal"))).where("_r = 1").drop("_r")


def name_coverage(records: DataFrame, phrases: DataFrame) -> DataFrame:
    """Names of each record that no reviewed name phrase spells."""
    names = records.select("entity_id", F.explode("names").alias("name"))
    spelled = phrases.where("intent = 'name'").select("entity_id", F.lower("phrase").alias("_p")).distinct()
    return names.join(spelled, (names["entity_id"] == spelled["entity_id"]) & (F.lower("name") == F.col("_p")), "left_anti")


def relevant_citations(rows: DataFrame) -> DataFrame:
    """Whether each quote stands at its exact place in the raw source (code points)."""
    return rows.withColumn("exact", F.substring(F.col("raw"), F.col("begin") + 1, F.col("end") - F.col("begin")) == F.col("quote"))
