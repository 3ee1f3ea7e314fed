"""Keyed upsert: O-61.

A put replaces the whole item, and the last row for a key wins. In Spark:
the batch is reduced to the last row per key with ``max_by`` (an ordinary
aggregate with a map-side partial step, so a key holding a third of the batch
costs one row per task), then the target keeps only keys the batch does not
have (``left_anti``) and the batch rows are appended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, key: str | Sequence[str], order) -> DataFrame:
    """The last row (greatest ``order``) of each key; missing cells of that
    row stay missing (whole-row replace)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    ocols = [F.col(o) if isinstance(o, str) else o for o in order]
    ordk = ocols[0] if len(ocols) == 1 else F.struct(*ocols)
    vals = [c for c in batch.columns if c not in keys]
    red = batch.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in vals]), ordk).alias("_r"))
    return red.select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in vals])


def upsert(target: DataFrame, batch: DataFrame, key: str | Sequence[str], order=None) -> DataFrame:
    """Target after putting every batch row (by key, last row wins).

    Batch columns absent from the target are dropped; target columns absent
    from a batch row are empty afterwards (the item is replaced)."""
    keys = [key] if isinstance(key, str) else list(key)
    if order is not None:
        batch = last_per_key(batch, keys, order)
    cols = target.columns
    batch = batch.select(*[(F.col(f"`{c}`") if c in batch.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in cols])
    kept = target.join(batch.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(batch)
