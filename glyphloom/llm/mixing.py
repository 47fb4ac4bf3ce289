"""Mixing sources to target weights, by nested hash-threshold histograms, in DataFrame functions only.

``mix_sources`` gives every source a share of all words by weight, caps it at ``most`` times the
source's own words and reshares the excess.  A source of ``s`` words and target ``t`` takes
every document ``floor(t / s)`` times; which documents are taken once more is decided by a threshold
on a row's hashes: words are summed by source and hash bucket, the bucket in which the budget ends is
refined, and so on, and rows under the threshold are kept.  Nothing is sorted but the histograms,
whose size is bounded by sources x 4096.

A row has two hashes: 36 bits of id and text, refined in three levels, and 24 bits of its place in the sized
table, in two more.  The second only decides among rows that agree in the first (repeated rows, of which the
right number is then taken); such rows are alike, so runs agree.  Per-source values reach the rows by a broadcast
of at most ``BROADCAST_SOURCES`` sources; beyond that the rows are salted by hash, so no source's rows meet.
The table of sources itself, one row each, passes through one task (10 million of them are some 500 MB).

Defined cases: a null text has 0 words and takes 0; a null source is a source of its own, last in
order; a null id hashes as the empty string, with its text; an empty table gives an empty result; a source
without words has target 0.  Extra columns pass through ``mix_sources`` untouched; columns named as
those in ``ADDED`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphloom.llm._storage import stored

LEVEL_BITS = 12
#: Levels of the hash of id and text, and of that of a row's place.
TEXT_LEVELS, PLACE_LEVELS = 3, 2
LEVELS = TEXT_LEVELS + PLACE_LEVELS
#: Sources, one row of some 60 bytes each, up to which their limits are broadcast; copies of the limits beyond that.
BROADCAST_SOURCES = 20_000
SALTS = 64
#: What the operator adds to its input.
ADDED = ("size", "source_size", "target", "copies", "taken")
WEIGHTS = (1, 2, 3)
MOST = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix_hash(doc_id: Column, text: Column) -> Column:
    """36 bits of the md5 of id and text, the same in any engine."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, LEVEL_BITS * TEXT_LEVELS // 4), 16, 10).cast("long")


def place_hash(place: Column) -> Column:
    """60 bits: those of ``mix_hash`` first, then 24 of the row's place."""
    low = F.pmod(F.xxhash64(place), F.lit(1 << LEVEL_BITS * PLACE_LEVELS))
    return F.shiftleft(F.col("_hash"), LEVEL_BITS * PLACE_LEVELS) + low


def with_source(rows: DataFrame, values: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """``rows`` (source, _hash) with the row of ``values`` (_source) of their source."""
    if few:
        return rows.join(F.broadcast(values), F.col("source").eqNullSafe(F.col("_source")), how)
    salted = values.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = F.col("source").eqNullSafe(F.col("_source")) & (F.pmod("_hash", F.lit(SALTS)) == F.col("_salt"))
    return rows.join(salted.hint("merge"), met, how).drop("_salt")


def source_targets(slim: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """From (source, size) rows one row per source: source, source_size, target, by water-filling.

    Sources fill up in the order of cap / weight, so those that reach their cap are a prefix of that
    order, and the first that stays below its cap sets the level of all the rest.  The windows here see
    one row per source, never documents.
    """
    named = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = W.orderBy(F.col("source").isNull(), F.col("source").cast("string").cast("binary"))
    named = named.withColumn("_place", F.row_number().over(place))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = named.withColumn("_weight", F.element_at(cycle, ((F.col("_place") - 1) % len(weights) + 1).cast("int")))
    named = named.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    ratio = F.col("_cap") / F.col("_weight")
    everything = W.partitionBy(F.lit(0))
    earlier = everything.orderBy(ratio, "_place").rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))
    weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0))
    named = named.withColumn("_level", rest / weight)
    free = F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.struct(ratio.alias("r"), "_place", "_level"))
    named = named.withColumn("_set", F.min(free).over(everything)["_level"])
    target = F.coalesce(F.least(F.col("_cap"), F.col("_set") * F.col("_weight")), F.col("_cap"))
    return named.select("source", "source_size", target.alias("target"))


def thresholds(slim: DataFrame, targets: DataFrame, few: bool) -> DataFrame:
    """Per source with words: _source, source_size, target, _times (whole copies), _below (hash limit)."""
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("_times", times).withColumn("_budget", F.greatest(F.lit(0.0), F.col("target") - F.col("_times") * F.col("source_size")))
    state = plan.select(F.col("source").alias("_source"), F.col("_budget").alias("_left"), F.lit(0).cast("long").alias("_prefix"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        marked = with_source(slim, state, few).where(F.shiftright("_hash", shift + LEVEL_BITS) == F.col("_prefix"))
        buckets = marked.groupBy("_source", F.shiftright("_hash", shift).alias("_bucket")).agg(F.sum("size").alias("_words"), F.first("_left").alias("_left"))
        buckets = buckets.withColumn("_upto", F.sum("_words").over(W.partitionBy("_source").orderBy("_bucket")))
        over = F.when(F.col("_upto") > F.col("_left"), F.struct("_bucket", "_words", (F.col("_left") - F.col("_upto") + F.col("_words")).alias("_left")))
        edge = buckets.groupBy("_source").agg(F.min(over).alias("_edge")).where(F.col("_edge").isNotNull())
        # one row for each source, written so that no later level runs the earlier ones again
        state = stored(edge.select("_source", F.col("_edge._left").alias("_left"), F.col("_edge._bucket").alias("_prefix"), F.col("_edge._words").alias("_words")), "mix-edge")
    # the last bucket is a single hash value: it is taken if that comes nearer to the budget
    nearer = (F.col("_words") - F.col("_left") < F.col("_left")).cast("long")
    limit = state.select(F.col("_source").alias("_s"), (F.col("_prefix") + nearer).alias("_below"))
    joined = plan.join(limit, F.col("source").eqNullSafe(F.col("_s")), "left")
    return joined.select(F.col("source").alias("_source"), "source_size", "target", "_times", F.coalesce("_below", F.lit(0)).cast("long").alias("_below"))


def taken_copies(sized: DataFrame, limits: DataFrame, few: bool) -> DataFrame:
    """``sized`` (with source, size, _hash) and what the mix takes of each row."""
    copies = F.when(F.col("size") > 0, F.col("_times") + (F.col("_hash") < F.col("_below")).cast("long")).otherwise(F.lit(0).cast("long"))
    joined = with_source(sized, limits, few)
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("_source", "_times", "_below", "_hash")


def sized_documents(docs: DataFrame, carry: tuple[str, ...] | None) -> DataFrame:
    """The rows of ``docs``, or their columns ``carry``, with size and _hash, as a scratch table."""
    kept = docs.drop(*[c for c in docs.columns if c in ADDED or c == "_hash"])
    found = kept.withColumn("size", word_count(F.col("text"))).withColumn("_hash", mix_hash(F.col("doc_id"), F.col("text")))
    found = found.withColumn("_hash", place_hash(F.monotonically_increasing_id()))
    return stored(found.select(*dict.fromkeys((*(carry or kept.columns), "source", "size", "_hash"))), "mix")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, carry: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` (or only their columns ``carry``) with size, source_size, target, copies and taken."""
    sized = sized_documents(docs, carry)
    slim = sized.select("source", "size", "_hash")
    targets = stored(source_targets(slim, weights, most), "mix-targets")
    few = targets.count() <= BROADCAST_SOURCES
    limits = thresholds(slim, targets, few)
    return taken_copies(sized, limits, few)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The rows of ``docs``, with all columns as they are, each as many times as the mix takes it."""
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_document"))
    mixed = mix_sources(packed, weights, most, carry=("_document",))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    return mixed.where(F.col("copies") > 0).select("_document", times).select("_document.*")
