"""Scratch tables in the folder that the cluster shares.

The place is ``spark.checkpoint.dir`` of the session.  Only where that is unset (a single-machine
session such as a test) is one made, under the session's warehouse.  A written table is read back
without its lineage, so executors may be lost at any later time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; on a single machine, where that is unset, a folder in the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/glyphloom-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Remove scratch tables, as ``stored`` gave them, that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Keep Arrow batches to a few MB, so a batch of long texts fits a worker.

    Plans read the setting when they run, so it stays set in the session; a smaller limit of the caller's is kept.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not str(now).isdigit() or int(now) > most or int(now) < 0:
        spark.conf.set(key, str(most))


def input_bytes(column) -> object:
    from pyspark.sql import functions as F

    return F.coalesce(F.sum(F.octet_length(F.coalesce(column, F.lit("")))), F.lit(0)).cast("long")
