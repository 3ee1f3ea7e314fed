"""Load ledger and run report: O-70, O-71, O-72.

The ledger is append-only parquet: one row per attempt
``(path, table_name, n_rows, status, message, ts)``. Finished files are
known from the ledger (and the stream checkpoint), never from the input
folder being empty.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "path string, table_name string, n_rows bigint, status string, message string, ts timestamp"
#: ``partial``: a row range of the file was loaded; ``profiled``: only its
#: sidecar was written; ``split``: its parts are published, in the folder that
#: the message names. None of them marks the file as loaded.
STATUSES = ("done", "partial", "profiled", "split", "failed", "pending")


def append_ledger(spark: SparkSession, ledger_path: str, rows: DataFrame) -> None:
    """O-70: append attempts (missing columns are filled)."""
    cols = {"path", "table_name", "n_rows", "status", "message", "ts"}
    out = rows
    for c, t in (("table_name", "string"), ("n_rows", "bigint"), ("message", "string")):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    if "ts" not in out.columns:
        out = out.withColumn("ts", F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp"))
    # Each append is its own folder (``attempt=<id>``), so concurrent writers
    # (tables loaded in parallel, stream batches) never share a commit folder.
    target = f"{ledger_path.rstrip('/')}/attempt={uuid.uuid4().hex}"
    out.select(*[c for c in ("path", "table_name", "n_rows", "status", "message", "ts") if c in cols]).write.mode("errorifexists").parquet(target)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """All attempts; empty where no ledger was written yet. Any other error
    is the caller's to see: a ledger that cannot be read is not an empty one."""
    from .tables import list_dirs

    if not list_dirs(spark, ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    df = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    return df.select("path", "table_name", "n_rows", "status", "message", "ts")


def file_status(ledger: DataFrame) -> DataFrame:
    """Status per file: ``done`` once any attempt finished, else ``partial``,
    ``profiled``, ``split`` or ``failed``, in this order."""
    had = {x: F.max(F.when(F.col("status") == x, 1)) == 1 for x in ("done", "partial", "profiled", "split")}
    status = F.lit("failed")
    for x in ("split", "profiled", "partial", "done"):
        status = F.when(had[x], F.lit(x)).otherwise(status)
    return ledger.groupBy("path").agg(status.alias("status"))


def run_report(catalog: DataFrame, ledger: DataFrame, rows_col: str = "n_rows") -> DataFrame:
    """O-72: files and rows per table and status; files without an attempt
    are ``pending`` (done vs still to go)."""
    files = catalog.filter(~F.col("is_metadata")).select("path", "table_name", F.col(rows_col).alias("n_rows"))
    st = file_status(ledger)
    joined = files.join(st, on="path", how="left").withColumn("status", F.coalesce("status", F.lit("pending")))
    return joined.groupBy("table_name", "status").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").cast("bigint").alias("n_rows")
    )
