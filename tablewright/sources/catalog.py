"""File catalogue and file-set relations: O-03, O-06 … O-11, O-71.

The catalogue is a DataFrame of file paths (``binaryFile`` listing with the
content column pruned away), so every file-set question is a projection,
``distinct`` or a semi/anti join, and scales with the number of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import base_name, table_name_of
from ..functions.patterns import METADATA_PREFIX, TABLE_NAME_PATTERN

CATALOG_COLUMNS = ("path", "name", "is_metadata", "data_name", "table_name", "part", "length")


def list_files(spark: SparkSession, path: str, glob: str = "*.csv", recursive: bool = False) -> DataFrame:
    """``(path, length)`` of the files under ``path`` matching ``glob``;
    only metadata is read (ReadSchema holds no ``content``)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", "length")
    )


def catalog_from_paths(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """O-03: classify files: sidecar or data, table name, part number; other
    columns of the listing are kept."""
    name = base_name(F.col(path_col))
    is_meta = name.startswith(METADATA_PREFIX)
    data_name = F.when(is_meta, F.substring(name, len(METADATA_PREFIX) + 1, 1 << 20)).otherwise(name)
    part = F.regexp_extract(data_name, r"_split__([0-9]{3,})\.csv$", 1)
    length = F.col("length") if "length" in listing.columns else F.lit(None).cast("long")
    return listing.select(
        F.col(path_col).alias("path"),
        name.alias("name"),
        is_meta.alias("is_metadata"),
        data_name.alias("data_name"),
        table_name_of(data_name).alias("table_name"),
        F.when(part != "", part.try_cast("bigint")).alias("part"),
        length.alias("length"),
        *[c for c in listing.columns if c not in (*CATALOG_COLUMNS, path_col)],
    )


def file_catalog(spark: SparkSession, path: str, glob: str = "*.csv", recursive: bool = False) -> DataFrame:
    """O-03: list + classify (``notes.txt`` and sub-folders are left out by
    the glob; decision D12). A folder that parts were written to (O-44) is
    catalogued from its part list."""
    from ..operators.split import PART_LIST, part_list
    from ..sinks.tables import path_exists

    if path_exists(spark, f"{path.rstrip('/')}/{PART_LIST}"):
        return catalog_of_parts(part_list(spark, path))
    return catalog_from_paths(list_files(spark, path, glob, recursive))


def catalog_of_parts(parts: DataFrame) -> DataFrame:
    """O-03 for a part list: names and part numbers are those of the list."""
    return parts.select(
        "path", "name", F.lit(False).alias("is_metadata"), F.col("name").alias("data_name"), "table_name", "part", "length", "names", "encoding", "sidecar"
    )


def data_files(catalog: DataFrame) -> DataFrame:
    return catalog.filter(~F.col("is_metadata"))


def metadata_files(catalog: DataFrame) -> DataFrame:
    return catalog.filter(F.col("is_metadata"))


def tables_to_load(catalog: DataFrame) -> DataFrame:
    """O-07: distinct table names of the data files."""
    return data_files(catalog).select("table_name").distinct()


def files_without_metadata(catalog: DataFrame) -> DataFrame:
    """O-08: data files with no ``metadata_`` twin of the same name."""
    meta = metadata_files(catalog).select(F.col("data_name").alias("name"))
    return data_files(catalog).join(meta, on="name", how="left_anti")


def invalid_table_names(catalog: DataFrame) -> DataFrame:
    """O-09: table names outside 3–255 characters of ``[A-Za-z0-9_.-]``."""
    return tables_to_load(catalog).filter(~F.col("table_name").rlike(TABLE_NAME_PATTERN))


def name_collisions(catalog: DataFrame, existing: DataFrame) -> DataFrame:
    """O-10: tables to load that already exist (single-part mode halts)."""
    return tables_to_load(catalog).join(existing.select("table_name"), on="table_name", how="left_semi")


def tables_to_create(catalog: DataFrame, existing: DataFrame) -> DataFrame:
    """O-11: tables to load that do not exist yet (decided per table, D10)."""
    return tables_to_load(catalog).join(existing.select("table_name"), on="table_name", how="left_anti")


def remaining_files(catalog: DataFrame, ledger: DataFrame) -> DataFrame:
    """O-71: data files the ledger does not mark ``done``."""
    done = ledger.filter(F.col("status") == "done").select("path")
    return data_files(catalog).join(done, on="path", how="left_anti")
