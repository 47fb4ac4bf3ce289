"""A training corpus from ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns as
Parquet in the shared folder and rereads it as the next one's docs.  All but the last stage return the
columns of documents.  The mix gives a document as many times as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.llm import language_id, mixing, near_dedup, packing, quality
from glyphloom.llm._storage import stored
from glyphloom.llm.queries import tokenizer_path

#: A language is believed from this score on.  The score is the share of the text's n-grams that the language knows, times
#: that share's part of the best two: text in no known language has next to no share, an even mixture of two gets about a quarter.
MIN_LANGUAGE_SCORE = 0.3
#: What the stages add, while they decide, is named so that no column of the documents is hidden by it.
PREFIX = "_pipeline_"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), tuple(docs.columns), prefix=PREFIX)
    return found.where(f"{PREFIX}keep").select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language_id.identify(docs, tuple(docs.columns), prefix=PREFIX)
    sure = (F.col(f"{PREFIX}lang_pred") != language_id.UNKNOWN) & (F.col(f"{PREFIX}score") >= MIN_LANGUAGE_SCORE)
    return found.where(sure).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_dedup", dedup_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: Trained stages and token ids have no SQL; tests/llm holds a run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
