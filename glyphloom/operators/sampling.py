"""Deterministic samples: bottom-k by hash, audit order, stratified and rotating picks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bottom_k(rows: DataFrame, groups: list[str], rank: Column, k: int, tie: list[str]) -> DataFrame:
    """The k rows of each group with the smallest rank.  Spark keeps at most k of a group in each task before it shuffles."""
    return rows.withColumn("rank_hash", rank).withColumn("_r", F.row_number().over(W.partitionBy(*groups).orderBy("rank_hash", *tie))).where(F.col("_r") <= k).drop("_r")


def audit_sample(rows: DataFrame, rank: Column, n: int, tie: list[str]) -> DataFrame:
    return rows.withColumn("sample_hash", rank).orderBy("sample_hash", *tie).limit(n)


def stratified_round_robin(rows: DataFrame, stratum: str, order: list[Column], size: int) -> DataFrame:
    """The first of every stratum in stratum order, then the second of every one, until ``size``."""
    ranked = rows.withColumn("_r", F.row_number().over(W.partitionBy(stratum).orderBy(*order)))
    return ranked.where(F.col("_r") <= size).orderBy("_r", stratum).limit(size).withColumnRenamed("_r", "pick")


def rotating_fill(rows: DataFrame, category: str, order: list[str], size: int) -> DataFrame:
    """Rotate over categories by a running turn number, modulo how many are left; an exhausted one drops out.

    The turn number doesn't move when a category drops out, so whose turn it is shifts.  Inherently
    sequential over categories: only the first ``size`` rows of each come to the single task that walks them.
    """
    ranked = rows.withColumn("_r", F.row_number().over(W.partitionBy(category).orderBy(*order))).where(F.col("_r") <= size)

    columns, schema = [*rows.columns, "pick"], T.StructType([*rows.schema.fields, T.StructField("pick", T.LongType())])

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(frames))
        queues = [(c, list(g.sort_values("_r").to_dict("records"))) for c, g in sorted(pdf.groupby(category), key=lambda x: x[0])]
        turn, picked = 0, []
        while queues and len(picked) < size:
            at = turn % len(queues)
            rest = queues[at][1]
            picked.append(rest.pop(0))
            if rest:
                turn += 1
            else:
                del queues[at]
        out = pd.DataFrame(picked, columns=pdf.columns)
        out["pick"] = range(1, len(out) + 1)
        yield out[columns]

    return ranked.coalesce(1).mapInPandas(walk, schema)
