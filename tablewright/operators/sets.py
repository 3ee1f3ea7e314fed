"""Unions of parts: O-50, O-51."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.delimited import read_by_header


def combine_parts(parts: Sequence[DataFrame], part_names: Sequence[str] | None = None, part_col: str | None = None) -> DataFrame:
    """O-50: append parts in name order, matching columns by name; a column
    missing from a part is empty there. ``part_col`` records the part name,
    so file order stays recoverable as ``(part, position)``."""
    if not parts:
        raise ValueError("no parts")
    items = list(zip(part_names, parts)) if part_names is not None else list(enumerate(parts))
    items.sort(key=lambda x: x[0])
    dfs = []
    for name, df in items:
        if part_col is not None:
            df = df.withColumn(part_col, F.lit(str(name)))
        dfs.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_table(spark, paths: Sequence[str], reader=read_by_header) -> DataFrame:
    """O-51: all parts of one table, each read by its own header, by column
    name (``reader`` is a function ``(spark, paths) -> DataFrame``)."""
    return reader(spark, list(paths))
