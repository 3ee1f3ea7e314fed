"""Splitting a table into parts under a row threshold: O-40 … O-44.

Semantics kept from the reference: k halvings where k is the least value
with ``n / 2**k + k <= threshold``; a part of m rows is cut at
``m // 2 - 1`` (the first half is one row short); part x of a level becomes
parts 2x-1 and 2x of the next, so part numbers follow row order. Decisions:
``n <= threshold`` is one part (D5), one halving is allowed (D4), names use
``%03d``, which widens by itself; the number of parts has no limit.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import DEFAULT_SPLIT_THRESHOLD, SPLIT_NAME_FORMAT
from .ordinal import with_ordinal_and_count


def split_plan(n: int, threshold: int = DEFAULT_SPLIT_THRESHOLD) -> int:
    """O-40: number of halvings k for n rows (driver arithmetic)."""
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    k = 0
    while n / (2**k) + k > threshold:
        k += 1
        if k > threshold:  # k alone is over the threshold from here on
            raise ValueError(f"no halving brings {n} rows under a threshold of {threshold}")
    return k


def split_plan_col(n, threshold) -> "F.Column":
    """O-40 as a column: the least k with n/2^k + k <= threshold; 64 halvings
    bring any 64-bit count under one row. An error where no k will do, as
    ``split_plan`` raises."""
    n = F.col(n) if isinstance(n, str) else n
    t = F.lit(threshold) if isinstance(threshold, int) else threshold
    ks = F.filter(F.sequence(F.lit(0), F.lit(64)), lambda k: n / F.pow(F.lit(2.0), k) + k <= t)
    return F.when(n.isNotNull(), F.coalesce(F.array_min(ks), F.raise_error(F.lit("no halving brings the rows under the threshold")).cast("int")))


def split_bounds(n: int, k: int) -> list[tuple[int, int, int]]:
    """O-41: ``(part, lo, hi)`` half-open ordinal ranges after k halvings
    (a listing for reports; rows are assigned by ``part_of``)."""
    parts = [(0, n)]
    for _ in range(k):
        nxt = []
        for lo, hi in parts:
            cut = max((hi - lo) // 2 - 1, 0)
            nxt += [(lo, lo + cut), (lo + cut, hi)]
        parts = nxt
    return [(i + 1, lo, hi) for i, (lo, hi) in enumerate(parts)]


def part_name(table: str, part: int) -> str:
    """O-43: ``table_split__###.csv`` (more digits from part 1000 on)."""
    if part < 1:
        raise ValueError("parts are numbered from 1")
    return SPLIT_NAME_FORMAT % (table, part)


def part_names(table: str, k: int) -> list[str]:
    return [part_name(table, p) for p in range(1, 2**k + 1)]


def part_of(ordinal_col, n, k):
    """Part number of an ordinal: k halving steps by arithmetic, each going
    left (part 2p - 1) or right (part 2p) of the cut; no list of bounds, no
    join. ``n`` and ``k`` are numbers or columns.

    A step takes a whole Arrow batch of ordinals at once: as a fold per row
    (``aggregate``, which is not compiled) the steps took most of a split."""
    kind = "int" if isinstance(k, int) and k < 31 else "bigint"

    @F.arrow_udf("bigint")
    def halved(o: pa.Array, n: pa.Array, k: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow.compute as pc

        # a missing ordinal is beyond all cuts
        rest = pc.fill_null(o, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False).copy()
        size, steps = (pc.fill_null(x, 0).to_numpy(zero_copy_only=False) for x in (n, k))
        part = np.zeros(len(rest), dtype=np.int64)
        for step in range(int(steps.max(initial=0))):
            cut = np.maximum(size // 2 - 1, 0)
            right, on = rest >= cut, step < steps
            rest -= np.where(right & on, cut, 0)
            size = np.where(on, np.where(right, size - cut, cut), size)
            part = np.where(on, part * 2 + right, part)
        return pa.array(part + 1)

    o = F.col(ordinal_col) if isinstance(ordinal_col, str) else ordinal_col
    n, k = (F.lit(x) if isinstance(x, int) else x for x in (n, k))
    return halved(o.cast("bigint"), n.cast("bigint"), k.cast("bigint")).cast(kind)


def assign_parts(
    df: DataFrame,
    order=None,
    threshold: int = DEFAULT_SPLIT_THRESHOLD,
    n: int | None = None,
    part_col: str = "part",
    ordinal_col: str | None = None,
) -> DataFrame:
    """O-42: contiguous part numbers in row order so that no part exceeds
    the threshold. ``n`` (row count) is counted when not given."""
    name = ordinal_col or "_ordinal"
    out, count = with_ordinal_and_count(df, order, name)
    n = int(count) if n is None else n  # from the checkpointed partition counts
    k = split_plan(n, threshold)
    out = out.withColumn(part_col, part_of(name, n, k))
    return out if ordinal_col else out.drop(name)


PART_LIST = "_parts"
PART_LIST_SCHEMA = "path string, name string, table_name string, part bigint, names array<string>, encoding string, sidecar string, length bigint"


def write_parts(
    df: DataFrame,
    path: str,
    max_rows: int = DEFAULT_SPLIT_THRESHOLD,
    order=None,
    drop=(),
    table: str | None = None,
    sep: str = ",",
) -> DataFrame:
    """O-44: CSV files of at most ``max_rows`` rows each, contiguous in row
    order, and the list of them (``part_list``) that a folder load or the
    catalogue of ``path`` reads: path, part number and the part's name
    ``<table>_split__###.csv``. ``table`` defaults to the folder's name.

    Rows are shuffled once by their ordinal where that leaves them in order
    (a part that a task's border cuts is then two files, in order), else a
    part is one task's. Every call writes a folder of its own and its list last, so a call
    that stopped leaves nothing that is read, and a new call can follow."""
    spark = df.sparkSession
    name, attempt = table or path.rstrip("/").rsplit("/", 1)[-1], uuid.uuid4().hex
    placed, count = with_ordinal_and_count(df, order, "_pos")
    parts = placed.withColumn("part", part_of("_pos", int(count), split_plan(int(count), max_rows)))
    if not count.in_order:
        parts = parts.repartition("part")
    folder = f"{path.rstrip('/')}/{attempt}"
    write_part_files(parts.drop(*drop), folder, sep)
    listed = list_parts(spark, folder, name, [c for c in df.columns if c not in drop], None)
    listed.write.parquet(f"{path.rstrip('/')}/{PART_LIST}/attempt={attempt}")
    return part_list(spark, path)


def write_part_files(parts: DataFrame, folder: str, sep: str, group: int = 0) -> None:
    """Rows with ``part`` and ``_pos`` as CSV files under ``folder``, whose
    paths sort by part number; cells are written as they are. ``group`` tells
    parts apart that are written to one folder by several calls."""
    padded = parts.withColumn("part", F.lpad(F.col("part").cast("string"), 12, "0")).withColumn("group", F.lit(group))
    writer = padded.sortWithinPartitions("part", "group", "_pos").drop("_pos").write.mode("append").partitionBy("part", "group")
    for option, value in {"header": True, "escape": '"', "sep": sep, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}.items():
        writer = writer.option(option, value)
    writer.csv(folder)


def list_parts(spark, folder: str, table: str, names, sidecar: str | None, group: int = 0) -> DataFrame:
    """The part files of one ``write_part_files``, from their listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    part = F.regexp_extract("path", rf"/part=([0-9]+)/group={group}/[^/]*$", 1)
    files = files.where(part != "")
    part = part.cast("bigint")
    return files.select(
        "path",
        F.format_string(SPLIT_NAME_FORMAT.replace("%s", table.replace("%", "%%")), part).alias("name"),
        F.lit(table).alias("table_name"),
        part.alias("part"),
        F.array(*[F.lit(n) for n in names]).cast("array<string>").alias("names"),
        F.lit("UTF-8").alias("encoding"),
        F.lit(sidecar).cast("string").alias("sidecar"),
        "length",
    )


def part_list(spark, path: str, attempts=None) -> DataFrame:
    """The parts listed under ``path``: by all calls that wrote their list,
    or by the given ones."""
    parts = spark.read.schema(PART_LIST_SCHEMA + ", attempt string").parquet(f"{path.rstrip('/')}/{PART_LIST}")
    if attempts is not None:
        parts = parts.where(F.col("attempt").isin(list(attempts)))
    return parts.drop("attempt").orderBy("table_name", "part", "path")
