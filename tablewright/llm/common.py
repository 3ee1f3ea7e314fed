"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows handed to a Python task at a time: documents can be long, so a batch
#: holds few of them (512 documents of 100 kB are 50 MB).
BATCH_ROWS = 512

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Small Arrow batches, and workers that find this package.

    The package root is added to the workers' ``PYTHONPATH`` for runs from a
    checkout; on a cluster the package is installed or shipped with the job.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if REPO_ROOT not in paths:
        env["PYTHONPATH"] = ":".join([REPO_ROOT, *paths])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and a lost
    executor costs only the tasks that read it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, *more: str | Column) -> DataFrame:
    """(doc_id, text) of a documents table, a null text as an empty one."""
    return df.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)
