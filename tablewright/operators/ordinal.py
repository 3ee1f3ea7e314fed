"""Row numbering and positional slices: O-30, O-31, O-32, O-17.

A global position is computed without moving every row into one partition
(``row_number().over(Window.orderBy(..))`` would), in one of three ways:

* Rows that are already in file order are counted per file and split
  (``with_file_ordinal``): no sort, no shuffle, no copy.
* Rows of a plain scan are cut into ranges of the order (``RangeCuts``): a
  seeded sample gives the cuts, which are literals in the plan, so every pass
  over the scan cuts alike; ranges are counted; then each range is shuffled to
  the task of its number, sorted there, and numbered from its offset. The
  row's place in its file ends the order, so a hot value and even identical
  rows spread over ranges. One shuffle, no copy; a scan that does not repeat
  itself fails the job instead of misnumbering.
* Other plans are range-partitioned by Spark and the sorted rows written once
  as a parquet table in the shared ``spark.checkpoint.dir``: Spark samples
  bounds anew for every branch of a plan, so the counts and the numbering must
  read one copy. (Columns parquet cannot store fall back to ``checkpoint()``.)
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import accumulate
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import sql_string
from ..functions.patterns import ROW_KEY_NAME
from ..session import ensure_checkpoint_dir, scratch_path

_LOW33 = (1 << 33) - 1
#: Columns of a scan in file order (``sources.delimited``): file, split, row.
FILE_ORDER = ("_file", "_block", "_row")


def _order_cols(df: DataFrame, order) -> list[Column]:
    if order is None:
        order = df.columns
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(f"`{o}`") if isinstance(o, str) else o for o in order]


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_ordinal(
    df: DataFrame,
    order=None,
    name: str = "_ordinal",
    num_partitions: int | None = None,
    tiebreak: bool = True,
) -> DataFrame:
    """O-30: add the 0-based position of each row under ``order``.

    ``order`` defaults to all columns (whole rows), which is a total order up
    to identical rows; identical rows get distinct, interchangeable numbers.
    """
    return with_ordinal_and_count(df, order, name, num_partitions, tiebreak)[0]


def with_ordinal_and_count(
    df: DataFrame,
    order=None,
    name: str = "_ordinal",
    num_partitions: int | None = None,
    tiebreak: bool = True,
    store: str = "parquet",
) -> tuple[DataFrame, int]:
    """``with_ordinal`` plus the row count, read from the per-partition
    counts (one row per partition) instead of another pass over the data."""
    if is_file_order(df, order):
        return with_file_ordinal(df, name)
    cols = _order_cols(df, order)
    n = _partitions(df, num_partitions)
    cuts = RangeCuts.of(df, order) if tiebreak and store == "parquet" else None
    if cuts is not None:
        total = df.count()
        try:
            counted = cuts.counted(cuts.rows, total, n)
            return cuts.numbered(cuts.rows, counted, 0, name), _Count(total=total, in_order=True)
        except LongCut:
            pass
    keys = list(cols)
    base = df
    if tiebreak:
        base = df.withColumn("_tb", F.monotonically_increasing_id())
        keys = keys + [F.col("_tb")]
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    s = base.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    if store == "parquet" and _parquet_ok(s):
        path = scratch_path(spark, "ordinal")
        s.write.parquet(path)
        s = spark.read.parquet(path)
    else:
        s = s.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    counts = s.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-partition window here is bounded.
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    out = s.join(F.broadcast(offsets), pid == F.col("_pid"), "inner")
    out = out.withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    return out.drop("_pid", "_off", "_mid", "_tb"), _Count(counts)


def file_splits(df: DataFrame, *more: Column) -> DataFrame:
    """(_file, _block, _n, _first, _start, _in_file, _file_rows): every split
    of a scan in file order, with its rows, their first ``_row``, the rows
    before it in all files and in its own, and the file's rows; ``more``
    aggregates are per split."""
    counts = df.groupBy(*FILE_ORDER[:2]).agg(F.count(F.lit(1)).alias("_n"), F.min(FILE_ORDER[2]).alias("_first"), *more)
    every = Window.orderBy(*FILE_ORDER[:2]).rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    own = Window.partitionBy(FILE_ORDER[0]).orderBy(FILE_ORDER[1])
    return counts.select(
        "*",
        F.coalesce(F.sum("_n").over(every), F.lit(0)).alias("_start"),
        F.coalesce(F.sum("_n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_in_file"),
        F.sum("_n").over(Window.partitionBy(FILE_ORDER[0])).alias("_file_rows"),
    )


def join_splits(df: DataFrame, splits: DataFrame, start: str, name: str) -> DataFrame:
    """Add the position ``name`` = ``start`` of the row's split + its place in
    the split, and the other columns of ``splits``. The scan that is numbered
    must be cut as the one that was counted; if it was not (say, the number
    of cores changed between them), the job fails rather than misnumber."""
    of = {c: f"_of{c}" for c in FILE_ORDER[:2]}
    named = splits.select(*[F.col(c).alias(of.get(c, c)) for c in splits.columns])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(o) for c, o in of.items()])
    place = F.col(FILE_ORDER[2]) - F.col("_first")
    changed = F.raise_error(F.lit("the files were cut differently when they were counted; set spark.sql.files.minPartitionNum")).cast("bigint")
    out = df.join(named, same, "left")
    return out.withColumn(name, F.when(place.between(F.lit(0), F.col("_n") - 1), F.col(start) + place).otherwise(changed))


def with_file_ordinal(df: DataFrame, name: str = "_ordinal") -> tuple[DataFrame, "_Count"]:
    """O-30 for rows that are already in file order (a scan with ``_file``,
    ``_block`` and ``_row``): rows are counted per file and split, the counts
    are summed in order, and a row's position is its split's start plus its
    place in the split. Two scans, no sort, no shuffle of rows and no copy;
    the counts are one row per split."""
    splits = stored(file_splits(df), "file-ordinal")
    return join_splits(df, splits, "_start", name).select(*df.columns, name), _Count(splits)


def stored(small: DataFrame, name: str) -> DataFrame:
    """A small table written to the shared folder: computed once, and of
    known size, so that it is broadcast only if small."""
    path = scratch_path(small.sparkSession, name)
    small.coalesce(1).write.parquet(path)
    return small.sparkSession.read.schema(small.schema).parquet(path)


def is_file_order(df: DataFrame, order) -> bool:
    names = order if isinstance(order, (list, tuple)) else [order]
    return all(isinstance(o, str) for o in names) and tuple(names) == FILE_ORDER and set(FILE_ORDER) <= set(df.columns)


#: Plan nodes of a scan that yields the same rows whenever it is read.
_SCAN_NODES = frozenset(("Project", "Filter", "Relation"))
_UNSTEADY = ("rand(", "randn(", "uuid(", "shuffle(", "PythonUDF")
_CUT_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "boolean", "string")
#: Samples per range, and at most in all (as Spark's own range partitioner).
SAMPLES_PER_RANGE, MAX_SAMPLES = 20, 1_000_000
#: Characters of a text that a cut holds; an order of longer texts is left to
#: the stored copy (shorter cuts could not split texts that begin alike).
CUT_CHARS = 1000


class LongCut(ValueError):
    """A cut would need a text of more than ``CUT_CHARS`` characters."""


class Counted(NamedTuple):
    """Cuts in order, as SQL literals, and the rows of the ranges between."""

    cuts: list[list[str]]
    rows: list[int]


class RangeCuts:
    """Ranges of a total order over the rows of a plain scan. ``rows`` is the
    scan with the row's place in its file, which ends the order; ``keys`` are
    the order's columns (an order by expressions adds them)."""

    def __init__(self, rows: DataFrame, columns: list[str], keys: list[str]):
        self.rows, self.columns = rows, columns
        self.types = [rows.schema[k].dataType.simpleString() for k in keys]
        self.keys = [f"`{k}`" for k in keys]

    @classmethod
    def of(cls, df: DataFrame, order) -> "RangeCuts | None":
        """None where the rows are not those of a plain scan, or their order
        is not one of ascending plain values."""
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        nodes = [re.match(r"[\s:|+-]*(\w+)", line) for line in plan.splitlines()]
        if not all(m and m[1] in _SCAN_NODES for m in nodes) or any(x in plan for x in _UNSTEADY):
            return None
        parquet = re.search(r"^[\s:|+-]*Relation.* parquet\s*$", plan, re.M)
        if not parquet and not re.search(r"^[\s:|+-]*Relation.* (csv|text|json|orc)\s*$", plan, re.M):
            return None
        place = ["_metadata.row_index"] if parquet else ["_metadata.file_block_start"]
        if len(df.inputFiles()) > 1:
            place = ["_metadata.file_path", *place]
        try:
            given = df.columns if order is None else [order] if isinstance(order, (str, Column)) else list(order)
            if any(not isinstance(k, str) and re.search(r" NULLS (FIRST|LAST)'>$", str(k)) for k in given):
                return None
            keys = [*given, *[F.col(c) for c in place], *([] if parquet else [F.monotonically_increasing_id()])]
            names = [k if isinstance(k, str) else f"_k{i}" for i, k in enumerate(keys)]
            rows = df.select("*", *[k.alias(n) for k, n in zip(keys, names) if not isinstance(k, str)])
        except AnalysisException:  # a scan whose rows have no place
            return None
        if len(set(rows.columns)) < len(rows.columns):
            return None
        out = cls(rows, df.columns, names)
        return out if all(t in _CUT_TYPES for t in out.types) else None

    def _literal(self, values) -> list[str]:
        return [f"CAST({sql_string(v) if v is not None else 'NULL'} AS {t})" for v, t in zip(values, self.types)]

    def _key(self, values=None) -> str:
        return "struct({})".format(", ".join(f"{v} AS k{i}" for i, v in enumerate(values or self.keys)))

    def ranged(self, rows: DataFrame, cuts: list[list[str]]) -> DataFrame:
        """``rows`` with ``_range``: the number of cuts at or below the row.
        The first value finds its place among the cuts' first values; only
        where it is equal to one are whole keys compared."""
        if not cuts:
            return rows.withColumn("_range", F.lit(0))
        first, firsts = self.keys[0], f"array({', '.join(c[0] for c in cuts)})"
        middle = "get({}, (s.lo + s.hi) div 2)"
        held = middle.format(firsts)
        rows = rows.withColumn("_from", F.expr(self._bisect("0", len(cuts), f"({held} IS NULL AND {first} IS NOT NULL) OR {held} < {first}")))
        whole = self._bisect("_from", len(cuts), f"{middle.format('array({})'.format(', '.join(self._key(c) for c in cuts)))} <= {self._key()}")
        return rows.withColumn("_range", F.expr(f"CASE WHEN _from < {len(cuts)} AND get({firsts}, _from) <=> {first} THEN {whole} ELSE _from END")).drop("_from")

    @staticmethod
    def _bisect(low: str, high: int, below: str) -> str:
        """The first place from ``low`` on at which ``below`` does not hold."""
        step = f"CASE WHEN s.lo >= s.hi THEN s WHEN {below} THEN struct(CAST((s.lo + s.hi) div 2 + 1 AS INT) AS lo, s.hi AS hi) ELSE struct(s.lo AS lo, CAST((s.lo + s.hi) div 2 AS INT) AS hi) END"
        return f"aggregate(sequence(1, {high.bit_length()}), struct({low} AS lo, {high} AS hi), (s, i) -> {step}, s -> s.lo)"

    def counted(self, rows: DataFrame, total: int, n: int) -> Counted:
        """About ``n`` ranges of ``rows``, by a sample, with their counts (a
        row per range reaches the driver)."""
        wanted = min(SAMPLES_PER_RANGE * n, MAX_SAMPLES)
        keys = rows.select(*self.keys)
        sample = keys.sample(min(1.0, wanted / total), seed=7) if total > wanted else keys
        text = [F.left(F.col(k), F.lit(CUT_CHARS)) if t == "string" else F.col(k).cast("string") for k, t in zip(self.keys, self.types)]
        values = sample.orderBy(*self.keys).select(*text).collect()
        picked = [values[i * len(values) // n] for i in range(1, n)] if len(values) >= n else []
        if any(t == "string" and v is not None and len(v) >= CUT_CHARS for r in picked for v, t in zip(r, self.types)):
            raise LongCut
        cuts = [self._literal(r) for r in picked]
        found = {r[0]: r[1] for r in self.ranged(keys, cuts).groupBy("_range").count().collect()}
        return Counted(cuts, [found.get(i, 0) for i in range(len(cuts) + 1)])

    def numbered(self, rows: DataFrame, counted: Counted, offset: int, name: str) -> DataFrame:
        """``rows`` with their position: each range is one task's, sorted."""
        n = len(counted.rows)
        starts = list(accumulate(counted.rows, initial=offset))[:-1]
        numbers = lambda xs: "array({})".format(", ".join(f"{x}L" for x in xs))
        dealt = self.ranged(rows, counted.cuts).repartitionById(n, "_range").sortWithinPartitions(*self.keys)
        dealt = dealt.withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
        changed = F.raise_error(F.lit("the rows were read otherwise when they were counted")).cast("bigint")
        fits = F.col("_place") < F.expr(f"get({numbers(counted.rows)}, _range)")
        position = F.when(fits, F.expr(f"get({numbers(starts)}, _range)") + F.col("_place")).otherwise(changed)
        return dealt.select(*[F.col(f"`{c}`") for c in self.columns], position.alias(name))

    def between(self, rows: DataFrame, low: list[str] | None, high: list[str] | None) -> DataFrame:
        """Rows from the cut ``low`` on and below ``high``; the first value
        alone also bounds what is read."""
        if low is not None:
            rows = rows.where(f"{self.keys[0]} >= {low[0]}" if "NULL" not in low[0] else "true").where(f"{self._key()} >= {self._key(low)}")
        if high is not None:
            rows = rows.where(f"{self.keys[0]} IS NULL OR {self.keys[0]} <= {high[0]}" if "NULL" not in high[0] else "true").where(f"{self._key()} < {self._key(high)}")
        return rows

    def slice(self, start: int, stop: int, n: int, name: str) -> DataFrame:
        """Rows at positions [start, stop): ranges are counted, those that
        the slice lies in are counted again in finer ranges, until they hold
        little more than the slice; only they are shuffled and sorted."""
        rows, offset, total = self.rows, 0, self.rows.count()
        stop = min(stop, total)
        if start >= stop:
            return rows.limit(0).select(*[F.col(f"`{c}`") for c in self.columns], F.lit(0).cast("bigint").alias(name))
        while True:
            counted = self.counted(rows, total, n)
            ends = list(accumulate(counted.rows, initial=offset))
            first = next(i for i in range(len(counted.rows)) if ends[i + 1] > start)
            last = next(i for i in range(len(counted.rows)) if ends[i + 1] >= stop)
            inner = Counted(counted.cuts[first:last], counted.rows[first : last + 1])
            rows = self.between(rows, counted.cuts[first - 1] if first else None, counted.cuts[last] if last < len(counted.cuts) else None)
            offset, held = ends[first], sum(inner.rows)
            if held <= 2 * (stop - start) + FEW_ROWS or held > total // 2:
                out = self.numbered(rows, inner, offset, name)
                return out.where((F.col(name) >= start) & (F.col(name) < stop))
            total = held


#: Rows beside the slice that are not worth another count.
FEW_ROWS = 10_000


def _parquet_ok(df: DataFrame) -> bool:
    """Parquet stores every column type here but ``void`` and intervals."""
    from pyspark.sql import types as T

    bad = (T.NullType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)
    return not any(isinstance(f.dataType, bad) for f in df.schema.fields)


class _Count:
    """Row count computed on first use from the per-partition counts."""

    def __init__(self, counts: DataFrame | None = None, total: int | None = None, in_order: bool = False):
        self._counts, self._n = counts, total
        self.in_order = in_order  # tasks hold rows in order of their positions

    def __int__(self) -> int:
        if self._n is None:
            self._n = int(self._counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
        return self._n


def add_row_key(df: DataFrame, order=None, name: str = ROW_KEY_NAME, num_partitions: int | None = None) -> DataFrame:
    """O-31: 1-based row number as the new first column."""
    cols = list(df.columns)
    out = with_ordinal(df, order, "_ordinal", num_partitions)
    return out.select((F.col("_ordinal") + 1).alias(name), *[F.col(f"`{c}`") for c in cols])


def add_prefixed_key(
    df: DataFrame,
    prefix: str,
    order=None,
    name: str = "custom_primary_key",
    num_partitions: int | None = None,
) -> DataFrame:
    """O-32: ``prefix + "_" + n`` (n 1-based) as the new first column."""
    cols = list(df.columns)
    out = with_ordinal(df, order, "_ordinal", num_partitions)
    key = F.concat(F.lit(prefix), F.lit("_"), (F.col("_ordinal") + 1).cast("string"))
    return out.select(key.alias(name), *[F.col(f"`{c}`") for c in cols])


def row_range(
    df: DataFrame,
    order,
    start: int,
    stop: int,
    ordinal_name: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """O-17: rows at 0-based positions ``start <= n < stop`` under ``order``
    (half-open). Rows that tie under ``order`` keep their scan order, however
    long the slice is. ``ordinal_name`` keeps ``n``."""
    if start < 0 or stop < start:
        raise ValueError("row_range needs 0 <= start <= stop")
    name = ordinal_name or "_ordinal"
    cuts = None if is_file_order(df, order) else RangeCuts.of(df, order)
    out = None
    if cuts is not None:
        try:
            out = cuts.slice(start, stop, _partitions(df, num_partitions), name)
        except LongCut:
            pass
    if out is None:
        out = with_ordinal(df, order, name, num_partitions)
        out = out.filter((F.col(name) >= start) & (F.col(name) < stop))
    return out if ordinal_name else out.drop(name)
