"""Checkpoint state: replay of transition events, eligibility of work, recovery, run-state folds and rates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Attempts allowed for quality failures and for transport failures.
QUALITY_BUDGET, TRANSPORT_BUDGET = 2, 6
#: In which order waiting work is taken.
QUEUE_ORDER = ("failed", "quarantined", "stale", "untouched")


def replayed(events: DataFrame, keys: list[str], order: list[str], owner: str | None = None) -> DataFrame:
    """Checkpoints after all transition events (begin, progress, finish, fail, transport, stale, release).

    begin adds an attempt, a transport failure gives it back and counts on its own budget; the status follows
    from the last event that sets one.  With an ``owner`` column work is leased: events of another owner than the one
    whose begin came last have no effect while that work runs, so a begin under a live lease adds no attempt.
    """
    kind = F.col("event")
    at = F.struct(*order)
    if owner is not None:
        events = _effective(events, keys, order, owner)
    status = (
        F.when(kind == "begin", "running").when(kind == "finish", "complete").when(kind == "fail", "failed").when(kind == "transport", "failed").when(kind == "stale", "stale").when(kind == "release", "pending")
    )
    return events.groupBy(*keys).agg(
        F.max_by(status, F.when(status.isNotNull(), at)).alias("status"),
        F.greatest(F.lit(0).cast("long"), F.count_if(kind == "begin") - F.count_if(kind == "transport")).alias("attempts"),
        F.count_if(kind == "transport").alias("operational_failures"),
        F.max(at).getField(order[0]).alias("last"),
    )


def _effective(events: DataFrame, keys: list[str], order: list[str], owner: str) -> DataFrame:
    """The events that a lease lets through, by a fold over the events of a checkpoint (a few dozen) in order."""
    kind = "array<struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in events.schema if f.name not in keys) + ">>"
    rest = [c for c in events.columns if c not in keys]
    ordered = events.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("at"), F.struct(*rest).alias("e")))).alias("all"))
    start = F.struct(F.lit(None).cast("string").alias("holder"), F.expr(f"cast(array() as {kind})").alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        event, by = x["e"]["event"], x["e"][owner].cast("string")
        free = acc["holder"].isNull()
        begins, passes = (event == "begin") & (free | (acc["holder"] == by)), (event == "stale") & free | (event != "begin") & (acc["holder"] == by)
        holder = F.when(begins, by).when(passes & event.isin("finish", "fail", "transport", "release", "stale"), F.lit(None)).otherwise(acc["holder"])
        return F.struct(holder.alias("holder"), F.when(begins | passes, F.concat(acc["kept"], F.array(x["e"]))).otherwise(acc["kept"]).alias("kept"))

    return ordered.select(*keys, F.explode(F.aggregate("all", start, step)["kept"]).alias("e")).select(*keys, "e.*")


def recovered(checkpoints: DataFrame, live_owners: DataFrame) -> DataFrame:
    """Running work of owners that are gone becomes stale."""
    alive = checkpoints.join(live_owners.select("owner").distinct().withColumn("_alive", F.lit(True)), "owner", "left")
    return alive.withColumn("status", F.when((F.col("status") == "running") & F.col("_alive").isNull(), "stale").otherwise(F.col("status"))).drop("_alive")


def eligible(entities: DataFrame, checkpoints: DataFrame, key: str, rank: str, limit: int, prerequisite: DataFrame | None = None) -> DataFrame:
    """The next entities to work on: prerequisite complete, own checkpoint open and within both budgets.

    Order: failed, quarantined, stale, untouched; then rank, then key.
    """
    base = entities if prerequisite is None else entities.join(prerequisite.where("status = 'complete'").select(key), key, "left_semi")
    own = checkpoints.select(key, "status", "attempts", "operational_failures")
    joined = base.join(own, key, "left")
    open_ = F.col("status").isNull() | (F.col("status").isin("failed", "quarantined", "stale", "pending") & (F.col("attempts") < QUALITY_BUDGET) & (F.col("operational_failures") < TRANSPORT_BUDGET))
    rung = F.when(F.col("status") == "failed", 0).when(F.col("status") == "quarantined", 1).when(F.col("status").isin("stale", "pending"), 2).otherwise(3)
    return joined.where(open_).withColumn("rung", rung).orderBy("rung", rank, key).limit(limit).select(key, rank, "rung")


def run_state(events: DataFrame, keys: list[str], order: str, tie: str) -> DataFrame:
    """State of each site and phase after all its events: last status, largest progress, warnings, first and last time."""
    at = F.struct(order, tie)
    return events.groupBy(*keys).agg(
        F.max_by("event_type", at).alias("status"),
        F.max("value").alias("observed"),
        F.count_if(F.col("event_type") == "error").alias("warnings"),
        F.min(order).alias("started"),
        F.max(order).alias("updated"),
        F.count(F.lit(1)).alias("events"),
    )


def progress_rate(samples: DataFrame, keys: list[str], ts: str, value: str, tie: str, seconds: int = 6, most: int = 64) -> DataFrame:
    """Rate over the samples of the last ``seconds`` (at most ``most``), null if it can't be told.

    Needs two samples that span a quarter of a second and didn't fall.
    """
    by = W.partitionBy(*keys)
    sample = F.struct(F.col("_at"), F.col("_k"), F.col(value).alias("v"))
    numbered = samples.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")) / 1e6).withColumn("_k", F.row_number().over(by.orderBy(ts, tie)))
    # the earliest of the time frame, but not earlier than the 64th from here
    timely = F.min(F.struct("_k", sample.alias("s"))).over(by.orderBy("_at").rangeBetween(-seconds, 0))
    near = F.first(sample).over(by.orderBy("_k").rowsBetween(-(most - 1), 0))
    framed = numbered.withColumn("_timely", timely).withColumn("_near", near)
    first = F.when(F.col("_timely._k") >= F.col("_near._k"), F.col("_timely.s")).otherwise(F.col("_near"))
    joined = framed.withColumn("_first", first)
    span, gain = F.col("_at") - F.col("_first._at"), F.col(value) - F.col("_first.v")
    usable = (F.col("_k") > F.col("_first._k")) & (span >= 0.25) & (gain >= 0)
    return joined.select(*keys, ts, tie, F.when(usable, F.round(gain / span, 6)).alias("rate"))


def stage_progress(checkpoints: DataFrame, entities: int | Column) -> DataFrame:
    """Complete, open and failed work by stage, as shares of all entities."""
    total = F.lit(entities) if isinstance(entities, int) else entities
    return checkpoints.groupBy("stage").agg(
        F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status") == "running").alias("running"), F.count_if(F.col("status").isin("failed", "quarantined")).alias("failed")
    ).withColumn("share", F.coalesce(F.try_divide(F.col("complete"), total), F.lit(0.0)))


def stale_phases(records: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Records whose stored input key no longer is the current one."""
    return records.alias("r").join(keys.alias("k"), on).where(~F.col("r.input_key").eqNullSafe(F.col("k.input_key"))).select(on)


def throttled(events: DataFrame, keys: list[str], ts: str, tie: str, amount: str, seconds: float = 0.4) -> DataFrame:
    """At most one row of a key in ``seconds`` since its last one; amounts of those held back are added to the next.

    What is left when a key ends is its last row.  Each key's events are walked in order as a stream, so memory doesn't
    grow with a key.  Returns keys, ts, tie, amount and merged (events that the row stands for).
    """
    gap = round(seconds * 1_000_000)
    slim = events.select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), ts, tie, amount)
    dealt = slim.repartition(*keys).sortWithinPartitions(*keys, "_at", tie)
    schema = T.StructType([*(slim.schema[c] for c in (*keys, ts, tie)), T.StructField(amount, T.DoubleType()), T.StructField("merged", T.LongType())])

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last, held = None, 0, None

        for pdf in frames:
            out: list[tuple] = []
            for row in pdf.itertuples(index=False, name=None):
                key, at, own = row[: len(keys)], row[len(keys)], row[len(keys) + 1 :]
                if key != now:
                    if held is not None:
                        out.append(held)
                    now, last, held = key, None, None
                total, merged = (held[-2], held[-1]) if held is not None else (0.0, 0)
                held = (*key, *own[:2], total + (0.0 if pd.isna(own[2]) else float(own[2])), merged + 1)
                if last is None or at - last >= gap:
                    out.append(held)
                    last, held = at, None
            yield pd.DataFrame(out, columns=schema.names)
        if held is not None:
            yield pd.DataFrame([held], columns=schema.names)

    return dealt.mapInPandas(walk, schema)
