"""Input parallelism for CPU-heavy per-cell work."""

from __future__ import annotations

from pyspark.sql import DataFrame


#: Operators whose output partitions a shuffle or the optimizer sets already.
_SHUFFLING = ("Join", "Aggregate", "Repartition", "Rebalance", "Sort", "Window", "Distinct")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a frame over at least ``min_partitions`` tasks (default: the
    cluster's cores) when its scan yields fewer, e.g. a large file with one
    row group. A large input already has more splits than cores, so this is
    a no-op there and adds no shuffle. Frames behind a shuffle are left as
    they are: asking for their partitions would run it."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if any(name in plan for name in _SHUFFLING):
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
