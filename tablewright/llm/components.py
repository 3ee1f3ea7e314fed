"""Connected components of a link table by alternating star contractions.

Each round is two joins and aggregates over the current links; every round
is written to the shared folder, so lineage stays short and a lost executor
costs one round's tasks. Nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Tie each node's neighbours to the smallest node it sees: the larger
    neighbours (``larger``) or the smaller ones and the node itself."""
    if larger:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a < b").distinct()
    # here every link points from a larger node b to smaller ones a
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    tied = links.join(least, "b").where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return tied.union(least.select(F.col("least").alias("a"), "b")).distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the component is
    its smallest node. Links of a node to itself and null ends are ignored."""
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a < b")
    now = written(links.distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        now = written(_stars(_stars(now, True), False), "links")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("links did not settle")
    # settled: stars around each component's smallest node
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
