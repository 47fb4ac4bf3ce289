"""Deduplication, first- and last-wins merges, upserts, and set checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def content_keys(docs: DataFrame, text: str, id_column: str) -> tuple[DataFrame, DataFrame]:
    """(contents: hash, cid, text) with one row for each distinct text, and (records: id, cid).

    cid is the smallest id that has the text, so both are the same at any partitioning.  Expensive work on
    texts runs on ``contents`` and is joined back by cid.
    """
    hashed = docs.withColumn("hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    contents = hashed.groupBy("hash").agg(F.min(id_column).alias("cid"), F.first(text).alias(text))
    records = hashed.select(id_column, "hash").join(contents.select("hash", "cid"), "hash").select(id_column, "cid")
    return contents, records


def first_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by ``order``, which must be total for a defined result."""
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_r = 1").drop("_r")


def merged(old: DataFrame, new: DataFrame, key: list[str], rules: dict[str, str]) -> DataFrame:
    """Upsert: a full outer join on the key.  Rules by column: ``max``, ``min``, ``new``, ``old`` (keep if set), or
    ``keep:a,b``: the old value where it is one of these, else the new one."""
    joined = old.alias("o").join(new.alias("n"), [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key], "full")
    pick = {
        "max": lambda o, n: F.greatest(o, n),
        "min": lambda o, n: F.least(o, n),
        "new": lambda o, n: F.coalesce(n, o),
        "old": lambda o, n: F.coalesce(o, n),
    }

    def value(c: str, rule: str) -> Column:
        old_value, new_value = F.col(f"o.{c}"), F.col(f"n.{c}")
        if rule.startswith("keep:"):
            return F.when(old_value.isin(*rule[len("keep:") :].split(",")), old_value).otherwise(F.coalesce(new_value, old_value)).alias(c)
        return pick[rule](old_value, new_value).alias(c)

    return joined.select(*[F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in key], *[value(c, r) for c, r in rules.items()])


def replaced_selection(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """All rows of either; those in ``new`` are active and carry its columns, the rest keep theirs, inactive."""
    joined = old.alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "full")
    return joined.select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in key],
        *[F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in columns],
        F.coalesce("_new", F.lit(False)).alias("active"),
    )


def undirected(edges: DataFrame) -> DataFrame:
    """Edges without self loops, endpoints in order, the strongest of each pair."""
    ends = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), "reason", "strength")
    return ends.groupBy("left", "right", "reason").agg(F.max("strength").alias("strength"))


def exact_coverage(expected: Column, given: Column) -> Column:
    """Missing, extra and repeated members of an answer that must cover a set exactly."""
    missing, extra = F.array_except(expected, given), F.array_except(given, expected)
    repeated = F.size(given) - F.size(F.array_distinct(given))
    return F.struct(missing.alias("missing"), extra.alias("extra"), repeated.alias("repeated"), ((F.size(missing) == 0) & (F.size(extra) == 0) & (repeated == 0)).alias("exact"))


def chosen_sites(manifest: DataFrame, sites: list[str]) -> DataFrame:
    """The rows of a manifest (ordinal, site) for ``sites``, in the manifest's order; unknown or repeated names are errors."""
    known = {r["site"] for r in manifest.select("site").distinct().collect()}  # a manifest has one row for each site
    if unknown := sorted(set(sites) - known):
        raise ValueError(f"unknown sites: {', '.join(unknown)}")
    if len(set(sites)) != len(sites):
        raise ValueError("a site is named twice")
    return manifest.where(F.col("site").isin(*sites)).orderBy("ordinal")


def version_purge(tables: dict[str, DataFrame], column: str, keep: list[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Rows by table that a purge of all but ``keep`` versions would remove, and the tables without them."""
    stale = ~F.coalesce(F.col(column).isin(*keep), F.lit(False))
    parts = [t.agg(F.count_if(stale).alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, {name: t.where(~stale) for name, t in tables.items()}


def without_sites(rows: DataFrame, sites: list[str]) -> DataFrame:
    return rows.where(~F.col("site").isin(*sites))


def purge_plan(tables: dict[str, DataFrame], sites: list[str]) -> DataFrame:
    """Rows that a purge of sites would remove, by table."""
    parts = [t.where(F.col("site").isin(*sites)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merged_vocabulary(sources: DataFrame) -> DataFrame:
    """Source terms split at ; | and line ends, one row for each normalised term: sources united, identity beats unverified.

    ``sources``: (entity_id, source, identity boolean, terms, ordinal).
    """
    split = sources.select("entity_id", "source", "identity", F.posexplode(F.split("terms", r"[;\n|]")).alias("_at", "term"), "ordinal").withColumn("term", F.trim("term"))
    named = split.where("term <> ''").withColumn("normalized", F.trim(F.regexp_replace(F.lower("term"), r"[^\p{L}\p{N}]+", " ")))
    return named.where("normalized <> ''").groupBy("entity_id", "normalized").agg(
        F.min_by("term", F.struct("ordinal", "_at")).alias("term"), F.array_sort(F.collect_set("source")).alias("sources"), F.bool_or("identity").alias("identity")
    )
