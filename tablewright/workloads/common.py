"""Helpers shared by the registered queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_text(df: DataFrame, order_col: str | None = None, nulls: dict | None = None) -> DataFrame:
    """The table as a delimited file would present it: every column as text.

    ``order_col`` keeps that typed column as ``_o`` (the file order);
    ``nulls`` maps a column to a value turned into a missing cell.
    """
    nulls = nulls or {}
    cols = []
    if order_col is not None:
        cols.append(F.col(order_col).alias("_o"))
    for c in df.columns:
        x = F.col(c).cast("string")
        if c in nulls:
            x = F.when(x == F.lit(nulls[c]), F.lit(None).cast("string")).otherwise(x)
        cols.append(x.alias(c))
    return df.select(*cols)


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# A landed folder made from ``documents``: each document is one landed file
# (documents sharing a name share the file), names are built from source and
# language; German names carry a blank and Spanish ones are two letters long
# (both invalid table names); long documents land as multi-part files.
# ``labels`` says which files were loaded (quality 1: done, else failed) and
# which tables already exist (toxic 1). The same SQL text feeds Spark and the
# oracle, so both sides see identical inputs.
FILE_NAME_SQL = (
    "concat(CASE lang WHEN 'de' THEN concat(source, ' ', lang) WHEN 'es' THEN lang "
    "ELSE concat(source, '_', lang) END, "
    "CASE WHEN n_chars > 2000 THEN concat('_split__', lpad(CAST(n_chars % 5 + 1 AS VARCHAR), 3, '0')) ELSE '' END, "
    "'.csv')"
)
LISTING_SQL = f"""
SELECT concat('/landing/', {FILE_NAME_SQL}) AS path, count(*) AS n_rows FROM documents GROUP BY 1
UNION ALL
SELECT DISTINCT concat('/landing/metadata_', {FILE_NAME_SQL}) AS path, CAST(0 AS BIGINT) AS n_rows
FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""
LEDGER_SQL = f"""
SELECT DISTINCT concat('/landing/', {FILE_NAME_SQL}) AS path,
  CASE l.quality WHEN 1 THEN 'done' ELSE 'failed' END AS status
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
"""
EXISTING_SQL = f"""
SELECT DISTINCT regexp_replace({FILE_NAME_SQL}, '(_split__[0-9]{{3,}})?[.]csv$', '') AS table_name
FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1
"""


def register_views(spark: SparkSession, sf_dir: str, names) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, sf_dir, ["documents", "labels"])
    return spark.sql(LISTING_SQL.replace("VARCHAR", "STRING"))


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, sf_dir, ["documents", "labels"])
    return spark.sql(LEDGER_SQL.replace("VARCHAR", "STRING"))


def existing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, sf_dir, ["documents", "labels"])
    return spark.sql(EXISTING_SQL.replace("VARCHAR", "STRING"))
