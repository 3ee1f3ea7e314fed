"""Column profiling: O-20 … O-29, O-36.

Every operator is a grouped aggregate over the table's text cells. The full
profile reads the table once:

* cells are unpivoted to ``(by…, column_index, column_name, _ord, cell)``;
* level A groups by ``(column, typed_key)`` (map-side combined, so a value
  that fills a third of the table costs one row per task);
* level A' groups the few cells whose text is not already canonical by
  their raw text, which is what duplicate detection in *text* columns needs;
* level B reduces to one row per column (again map-side combined).

The dtype decision, tags, flags and example item are column expressions on
that one-row-per-column result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import is_inexact, is_missing, render_cell, sql_string, type_tag
from ..functions.patterns import BOOL_PATTERN, EXACT_DOUBLE_INT, FLOAT_PATTERN, INT_PATTERN, KEY_FLAG_NAMES, NA_TOKENS, UINT64_MAX
from .partitioning import ensure_parallelism

ORD = "_ord"


def _order_col(order) -> Column:
    """Ordering key whose minimum is the table's first row."""
    if order is None:
        return F.monotonically_increasing_id()
    if isinstance(order, (str, Column)):
        order = [order]
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def _value_columns(df: DataFrame, columns, by: Sequence[str]) -> list[str]:
    if columns is None:
        return [c for c in df.columns if c not in set(by)]
    return list(columns)


def text_cells(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order=None,
    by: Sequence[str] = (),
    with_names: bool = True,
) -> DataFrame:
    """Unpivot a table to one row per cell: ``(by…, _ord, column_name,
    column_index, cell)``; cells are text (columns are cast to string).
    ``with_names=False`` leaves the name out (it follows from the index)."""
    by = list(by)
    cols = _value_columns(df, columns, by)
    # Columns are renamed to their positions: the unpivot label is then the
    # index, and the name is a lookup in a literal array (no per-cell map).
    ords = [] if order is False else [_order_col(order).alias(ORD)]
    base = df.select(
        *[F.col(b) for b in by],
        *ords,
        *[F.col(f"`{c}`").cast("string").alias(str(i)) for i, c in enumerate(cols)],
    )
    # ``stack`` (a generator) rather than ``unpivot`` (an Expand): Spark 4.1
    # fails to compile subexpression-eliminated projections over Expand
    # outputs held in state arrays, and falls back to the interpreter.
    pairs = ", ".join(f"{i}, `{i}`" for i in range(len(cols)))
    keep = [*by, *([ORD] if ords else [])]
    long = base.select(*keep, F.expr(f"stack({len(cols)}, {pairs})").alias("column_index", "cell"))
    if not with_names:
        return long
    return long.select(*keep, column_name_of(cols).alias("column_name"), "column_index", "cell")


def column_name_of(cols: Sequence[str], index_col: str = "column_index") -> Column:
    """Name of a column from its position (a literal array lookup)."""
    return F.element_at(F.array(*[F.lit(c) for c in cols]), F.col(index_col) + 1)


FACT_COLUMNS = ("m", "k", "fi", "f64", "fu64", "ff", "fb")


def with_cell_facts(df: DataFrame, cell="cell", na_tokens=NA_TOKENS, prefix: str = "") -> DataFrame:
    """Add the per-cell facts the profile aggregates: ``m`` (missing), ``k``
    (the typed key) and the type flags ``fi f64 fu64 ff fb``.

    ``cell`` is a column name, or a list of them with ``prefix`` a matching
    list of name prefixes (one set of facts per column).

    Each regex test and each cast runs once per cell: the tests are columns
    of one projection and the casts, key and flags read those columns in the
    next ones. Catalyst does not merge a projection into its consumer when
    that would repeat a costly expression, so the stages stay apart, and all
    of them still run in one whole-stage-codegen function. (Nested as one
    expression, the integer pattern ran about eight times per cell.)

    The stages are written as SQL expressions (one ``selectExpr`` each): the
    same expressions built from ``Column`` objects cost thousands of driver
    round trips to the JVM for a wide table.
    """
    cells = [cell] if isinstance(cell, str) else list(cell)
    prefixes = [prefix] if isinstance(prefix, str) else list(prefix)
    tokens = ", ".join(sql_string(t) for t in na_tokens)
    blank = sql_string(" \t")

    def full(c: str, pattern: str) -> str:
        return f"{c} RLIKE {sql_string('^(?:' + pattern + ')$')}"

    def stage(out: DataFrame, make) -> DataFrame:
        exprs = []
        for cname, p in zip(cells, prefixes):
            c = f"`{cname}`"
            col = lambda x, p=p: f"`{p}{x}`"
            exprs += [f"{e} AS `{p}{name}`" for name, e in make(c, col).items()]
        return out.selectExpr("*", *exprs)

    def tests(c, col):
        missing = f"({c} IS NULL OR {c} IN ({tokens}))" if tokens else f"({c} IS NULL)"
        return {"m": missing, "_ii": full(c, INT_PATTERN), "_if": full(c, FLOAT_PATTERN), "_ib": full(c, BOOL_PATTERN)}

    # numeric casts only where the pattern matched (see functions.cells)
    trim = lambda c: f"btrim({c}, {blank})"
    out = stage(df, tests)
    out = stage(out, lambda c, col: {"_lv": f"CASE WHEN {col('_ii')} THEN try_cast({trim(c)} AS BIGINT) END"})
    out = stage(
        out,
        lambda c, col: {
            "_dec": f"CASE WHEN {col('_ii')} AND {col('_lv')} IS NULL THEN try_cast({trim(c)} AS DECIMAL(38,0)) END"
        },
    )
    out = stage(out, lambda c, col: {"_iok": f"{col('_ii')} AND ({col('_lv')} IS NOT NULL OR {col('_dec')} IS NOT NULL)"})
    out = stage(
        out, lambda c, col: {"_dv": f"CASE WHEN {col('_if')} AND NOT {col('_iok')} THEN try_cast({trim(c)} AS DOUBLE) END"}
    )

    def facts(c, col):
        m, ii, lv, dec, dv = col("m"), col("_ii"), col("_lv"), col("_dec"), col("_dv")
        int_text = f"CASE WHEN {lv} IS NOT NULL THEN CAST({lv} AS STRING) ELSE CAST({dec} AS STRING) END"
        # a double prints as an integer when it is whole and within 2**53
        whole = f"abs({dv}) <= CAST({EXACT_DOUBLE_INT} AS DOUBLE) AND {dv} = floor({dv})"
        dbl_text = f"CASE WHEN {whole} THEN CAST(CAST({dv} AS BIGINT) AS STRING) ELSE CAST({dv} AS STRING) END"
        key = (
            f"CASE WHEN {m} THEN CAST(NULL AS STRING) WHEN {col('_iok')} THEN {int_text} "
            f"WHEN {col('_if')} THEN {dbl_text} WHEN {col('_ib')} THEN lower({c}) ELSE {c} END"
        )
        u64 = (
            f"CASE WHEN {lv} IS NOT NULL THEN {lv} >= 0 ELSE {dec} BETWEEN CAST(0 AS DECIMAL(38,0)) "
            f"AND CAST('{UINT64_MAX}' AS DECIMAL(38,0)) END"
        )
        return {
            "k": key,
            "fi": f"{m} OR {ii}",
            "f64": f"{m} OR ({ii} AND {lv} IS NOT NULL)",
            "fu64": f"{m} OR ({ii} AND ({u64}))",
            "ff": f"{m} OR {col('_if')}",
            "fb": f"{m} OR {col('_ib')}",
        }

    out = stage(out, facts)
    return out.drop(*(f"{p}{x}" for p in prefixes for x in ("_ii", "_if", "_ib", "_lv", "_dec", "_iok", "_dv")))


#: Texts longer than this are grouped by a digest of this size.
LONG_KEY = 64


def short_key(k: Column) -> Column:
    """A grouping key of bounded width: long texts (whole documents) go
    through the shuffle as two independent hashes, 192 bits, and a length."""
    digest = F.concat_ws(":", F.md5(k.cast("binary")), F.hex(F.xxhash64(k)), F.octet_length(k).cast("string"))
    return F.when(F.octet_length(k) > LONG_KEY, digest).otherwise(k)


def _finish(stats: DataFrame, by: Sequence[str], with_dup: bool, na_tokens=NA_TOKENS, sums: Sequence[str] = ()) -> DataFrame:
    """One row per column of type statistics -> profile columns."""
    n_present = F.col("n_rows") - F.col("n_missing")
    has_missing = F.col("n_missing") > 0
    dtype = (
        F.when(F.col("n_rows") == 0, "object")
        .when(n_present == 0, "float64")
        .when(F.col("all_bool"), F.when(has_missing, "object").otherwise("bool"))
        .when(F.col("all_int") & F.col("all_i64"), F.when(has_missing, "float64").otherwise("int64"))
        .when(F.col("all_int") & F.col("all_u64"), F.when(has_missing, "float64").otherwise("uint64"))
        .when(F.col("all_int"), "object")
        .when(F.col("all_float"), "float64")
        .otherwise("object")
    )
    out = stats.withColumn("pandas_column_dtype", dtype)
    # A boolean column with a gap is ``object`` but still holds booleans.
    value_type = F.when((n_present > 0) & F.col("all_bool"), F.lit("bool")).otherwise(F.col("pandas_column_dtype"))
    cols = [
        *[F.col(b) for b in by],
        F.col("column_index"),
        F.col("column_name"),
        type_tag(F.col("pandas_column_dtype")).alias("AWS_column_dtype"),
        F.col("pandas_column_dtype"),
        F.when(is_missing(F.col("first_cell"), na_tokens), F.lit(None).cast("string"))
        .otherwise(render_cell(F.col("first_cell"), value_type))
        .alias("example_item_list"),
        (F.col("pandas_column_dtype") == "object").alias("mixed_datatype_flag_list"),
        has_missing.alias("missing_data_flag_list"),
    ]
    if with_dup:
        typed = value_type.isin("int64", "uint64", "float64", "bool")
        dup = F.when(typed, F.coalesce(F.col("max_typed") > 1, F.lit(False))).otherwise(
            F.coalesce(F.col("max_canon") > 1, F.lit(False)) | F.coalesce(F.col("noncanon_dup"), F.lit(False))
        )
        cols.append(dup.alias("duplicate_data_flag_list"))
    cols += [F.col(c).cast("long").alias(c) for c in ("n_rows", "n_missing", *sums)]
    return out.select(*cols)


# Largest number of groups (files) whose least-order keys are broadcast.
MAX_BROADCAST_GROUPS = 100_000


def first_cells(
    df: DataFrame, columns=None, order=None, by: Sequence[str] = (), n_groups: int | None = None
) -> DataFrame:
    """O-25 helper: the cells of each group's first row (least ``order``),
    as ``(by…, column_index, first_cell)``.

    The least order value (per group) is found by an aggregate that reads
    only the order column, and the rows holding it are picked by a broadcast
    semi-join; only those rows are cast to text. The broadcast side is one
    row without groups, or one row per group when the group count is known
    and within ``MAX_BROADCAST_GROUPS``. With more (or unknown) groups the
    row is a ``min_by`` per group, combined map-side, with no broadcast.
    """
    by = list(by)
    cols = _value_columns(df, columns, by)
    texts = [F.col(f"`{c}`").cast("string").alias(str(i)) for i, c in enumerate(cols)]
    if by and (n_groups is None or n_groups > MAX_BROADCAST_GROUPS):
        row = df.select(*[F.col(b) for b in by], _order_col(order).alias(ORD), F.struct(*texts).alias("_r"))
        row = row.groupBy(*by).agg(F.min_by("_r", ORD).alias("_r"))
        wide = row.select(*by, *[F.col(f"_r.`{i}`").alias(str(i)) for i in range(len(cols))])
    else:
        # The least order value per group (one row per group; a single row
        # without groups) is broadcast and the matching rows picked by a
        # semi-join: only those rows are cast to text.
        o = df.select(*[F.col(b) for b in by], _order_col(order).alias(ORD), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(cols)])
        mins = o.groupBy(*by).agg(F.min(ORD).alias(ORD))
        picked = o.join(F.broadcast(mins), on=[*by, ORD], how="left_semi")
        picked = picked.dropDuplicates(by) if by else picked.limit(1)
        wide = picked.select(*by, *[F.col(f"_c{i}").cast("string").alias(str(i)) for i in range(len(cols))])
    pairs = ", ".join(f"{i}, `{i}`" for i in range(len(cols)))
    return wide.select(*by, F.expr(f"stack({len(cols)}, {pairs})").alias("column_index", "first_cell"))


def column_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order=None,
    by: Sequence[str] = (),
    na_tokens: Iterable[str] = NA_TOKENS,
    with_dup: bool = True,
    with_example: bool = True,
    n_groups: int | None = None,
    plan: str = "rescan",
    sums: Sequence[str] = (),
) -> DataFrame:
    """Type, missing, duplicate and first-cell statistics per column.

    ``with_dup=False`` takes the wide path: a single map-side aggregate with
    a handful of accumulators per column and no Expand or value shuffle.

    ``plan``: ``"rescan"`` (default) shuffles cells once by (column, typed
    value) and re-reads the source for the few non-canonical cells and the
    first row; ``"one_scan"`` reads the source once but shuffles twice (a
    second pass over the distinct values). Measured on sf0.1 events
    (parquet) and lineitem (CSV, 6.6M cells) on local[8], ``rescan`` was
    1.4-1.5x faster: re-reading costs less than a second value shuffle.
    ``sums`` (one-scan plan only): columns of numbers per row that are added
    up along with the one column that is profiled.
    """
    by = list(by)
    na_tokens = tuple(na_tokens)
    columns = _value_columns(df, columns, by)
    # The file order is fixed as a column before rows are spread over tasks.
    if order is None and with_example:
        df = df.withColumn("_scan_pos", F.monotonically_increasing_id())
        order = "_scan_pos"
    df = ensure_parallelism(df)
    if not with_dup:
        return _finish(_wide_stats(df, columns, order, by, na_tokens, with_example, n_groups), by, False, na_tokens)
    if plan == "one_scan":
        if not _one_scan_ok(df, order, by, with_example, n_groups):
            raise ValueError("plan='one_scan' needs one fixed-width order column and a bounded group count")
        stats = _one_scan_stats(df, columns, order, by, na_tokens, with_example, sums)
        return _finish(stats, by, True, na_tokens, sums)

    cols = _value_columns(df, columns, by)
    # Grouping keys carry the column position only; names are attached to
    # the one-row-per-column result, which keeps shuffled rows small.
    cells = text_cells(df, cols, False, by, with_names=False)
    cells = with_cell_facts(cells, "cell", na_tokens).select(*by, "column_index", "cell", *FACT_COLUMNS)
    cells = cells.withColumn("canon", F.col("cell") == F.col("k")).withColumn("k", short_key(F.col("k")))
    keys = [*by, "column_index"]
    # Level A: one row per (column, typed value).
    level_a = cells.groupBy(*keys, "k").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("canon").alias("n_canon"),
        F.bool_and("fi").alias("all_int"),
        F.bool_and("f64").alias("all_i64"),
        F.bool_and("fu64").alias("all_u64"),
        F.bool_and("ff").alias("all_float"),
        F.bool_and("fb").alias("all_bool"),
    )
    # Level A': raw-text multiplicity of non-canonical present cells.
    level_a2 = (
        cells.filter(~F.col("m") & ~F.col("canon"))
        .groupBy(*keys, "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg((F.max("n") > 1).alias("noncanon_dup"))
    )
    present = F.col("k").isNotNull()
    level_b = level_a.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.bool_and("all_int").alias("all_int"),
        F.bool_and("all_i64").alias("all_i64"),
        F.bool_and("all_u64").alias("all_u64"),
        F.bool_and("all_float").alias("all_float"),
        F.bool_and("all_bool").alias("all_bool"),
        F.max(F.when(present, F.col("n"))).alias("max_typed"),
        F.max(F.when(present, F.col("n_canon"))).alias("max_canon"),
    )
    level_b = level_b.withColumn("column_name", column_name_of(cols))
    stats = _with_first(level_b.join(level_a2, on=keys, how="left"), df, cols, order, by, with_example, n_groups)
    return _finish(stats, by, True, na_tokens)


_FIXED_WIDTH = ("bigint", "int", "smallint", "tinyint", "timestamp", "timestamp_ntz", "date", "double", "float")


def type_evidence(df: DataFrame, columns: Sequence[str], na_tokens=NA_TOKENS) -> tuple[DataFrame, list[Column]]:
    """``df`` with the facts of its cells, and aggregates over them from which
    ``dtype_of_evidence`` decides each column's type: flags that stay the same
    however often a row is counted, so they can be observed (``df.observe``)
    beside another job's work. ``inexact`` tells of whole numbers that a
    double would round."""
    prefixes = [f"_x{i}_" for i in range(len(columns))]
    out = with_cell_facts(df, list(columns), tuple(na_tokens), prefixes) if columns else df
    aggs = [F.coalesce(F.bool_or(F.lit(True)), F.lit(False)).alias("rows")]
    for i, (c, p) in enumerate(zip(columns, prefixes)):
        whole = F.when(F.col(f"{p}fi") & ~F.col(f"{p}m"), F.col(f"`{c}`"))
        flags = {
            "missing": F.bool_or(f"{p}m"),
            "present": F.bool_or(~F.col(f"{p}m")),
            "inexact": F.bool_or(is_inexact(whole)),
            **{k: F.bool_and(f"{p}{f}") for k, f in (("int", "fi"), ("i64", "f64"), ("u64", "fu64"), ("float", "ff"), ("bool", "fb"))},
        }
        aggs += [F.coalesce(v, F.lit(k not in ("missing", "present", "inexact"))).alias(f"{k}_{i}") for k, v in flags.items()]
    return out, aggs


def dtype_of_evidence(rows: bool, e: dict[str, bool]) -> str:
    """The pandas dtype (O-20) of a column with this evidence."""
    if not rows:
        return "object"
    if not e["present"]:
        return "float64"
    if e["bool"]:
        return "object" if e["missing"] else "bool"
    if e["int"] and (e["i64"] or e["u64"]):
        return "float64" if e["missing"] else "int64" if e["i64"] else "uint64"
    return "float64" if e["float"] and not e["int"] else "object"


def _one_scan_ok(df: DataFrame, order, by, with_example: bool, n_groups) -> bool:
    """The one-scan plan needs a fixed-width order key (hash aggregation
    keeps ``min`` of it) and, with groups, a known bound on their number
    (one row per group and column is broadcast)."""
    if not with_example:
        return True  # the order is only used for the example cell
    if by and (n_groups is None or n_groups > MAX_BROADCAST_GROUPS):
        return False
    if order is None:
        return True
    if isinstance(order, (list, tuple)):
        if len(order) != 1:
            return False
        order = order[0]
    if not isinstance(order, str):
        return False
    return dict(df.dtypes).get(order) in _FIXED_WIDTH


def _one_scan_stats(df: DataFrame, columns, order, by, na_tokens, with_example: bool, sums: Sequence[str] = ()) -> DataFrame:
    """All profile statistics from one scan of the source.

    * Level A groups cells by ``(column, typed key, nc)`` where ``nc`` is the
      raw text when it differs from the typed key (or is missing), so a level-A
      row is exactly one raw text: its count is that text's multiplicity
      (text duplicates), and ``coalesce(nc, k)`` gives the text back.
    * Level B groups by ``(column, typed key)``: typed duplicates.
    * Level C is one row per column; the first row's cell is the level-A row
      holding the column's least order value, found by joining level A's
      (already shuffled, reused) output with one broadcast row per column.
    """
    by = list(by)
    cols = _value_columns(df, columns, by)
    # Without an example cell no row order is needed: no position column
    # and no ``min`` of it is carried through the three levels.
    ords = [F.col(ORD).alias("_o")] if with_example else []
    cells = text_cells(df, cols, order if with_example else False, [*by, *sums], with_names=False)
    added = lambda: [F.sum(c).alias(c) for c in sums]
    cells = with_cell_facts(cells, "cell", na_tokens).select(
        *by, *sums, "column_index", *ords, "k", "fi", "f64", "fu64", "ff", "fb", "cell"
    ).withColumn("nc", F.when(F.col("k").isNull() | (F.col("cell") != F.col("k")), F.col("cell")))
    keys = [*by, "column_index"]
    level_a = cells.groupBy(*keys, "k", "nc").agg(
        F.count(F.lit(1)).alias("n"),
        *([F.min("_o").alias("min_o")] if with_example else []),
        *added(),
        F.bool_and("fi").alias("all_int"),
        F.bool_and("f64").alias("all_i64"),
        F.bool_and("fu64").alias("all_u64"),
        F.bool_and("ff").alias("all_float"),
        F.bool_and("fb").alias("all_bool"),
    )
    present = F.col("k").isNotNull()
    level_b = level_a.groupBy(*keys, "k").agg(
        F.sum("n").alias("total"),
        F.max("n").alias("max_n"),
        *([F.min("min_o").alias("min_o")] if with_example else []),
        *added(),
        *[F.bool_and(c).alias(c) for c in ("all_int", "all_i64", "all_u64", "all_float", "all_bool")],
    )
    level_c = level_b.groupBy(*keys).agg(
        F.sum("total").alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("total"))), F.lit(0)).alias("n_missing"),
        *[F.bool_and(c).alias(c) for c in ("all_int", "all_i64", "all_u64", "all_float", "all_bool")],
        F.max(F.when(present, F.col("total"))).alias("max_typed"),
        F.max(F.when(present, F.col("max_n"))).alias("max_canon"),
        *([F.min("min_o").alias("first_o")] if with_example else []),
        *added(),
    ).withColumn("noncanon_dup", F.lit(False)).withColumn("column_name", column_name_of(cols))
    if not with_example:
        return level_c.withColumn("first_cell", F.lit(None).cast("string"))
    firsts = F.broadcast(level_c.select(*keys, F.col("first_o").alias("min_o")))
    first = (
        level_a.join(firsts, on=[*keys, "min_o"], how="left_semi")
        .select(*keys, F.coalesce("nc", "k").alias("first_cell"))
        .dropDuplicates(keys)
    )
    return level_c.join(first, on=keys, how="left")


def _with_first(stats: DataFrame, df: DataFrame, columns, order, by, with_example: bool, n_groups=None) -> DataFrame:
    if not with_example:
        return stats.withColumn("first_cell", F.lit(None).cast("string"))
    return stats.join(first_cells(df, columns, order, by, n_groups), on=[*by, "column_index"], how="left")


def _wide_stats(df: DataFrame, columns, order, by, na_tokens, with_example: bool = True, n_groups=None) -> DataFrame:
    """Per-column accumulators in one aggregate row (per ``by`` group), then
    reshaped to one row per column."""
    cols = _value_columns(df, columns, by)
    base = df.select(*[F.col(b) for b in by], *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    # the typed key is not used here and is pruned away
    base = with_cell_facts(base, [f"c{i}" for i in range(len(cols))], na_tokens, [f"x{i}_" for i in range(len(cols))])
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i in range(len(cols)):
        aggs += [
            F.count_if(f"x{i}_m").alias(f"m{i}"),
            F.bool_and(f"x{i}_fi").alias(f"i{i}"),
            F.bool_and(f"x{i}_f64").alias(f"s{i}"),
            F.bool_and(f"x{i}_fu64").alias(f"u{i}"),
            F.bool_and(f"x{i}_ff").alias(f"f{i}"),
            F.bool_and(f"x{i}_fb").alias(f"b{i}"),
        ]
    wide = base.groupBy(*by).agg(*aggs)
    values = [
        F.struct(
            F.lit(i).alias("column_index"),
            F.col(f"m{i}").alias("n_missing"),
            F.col(f"i{i}").alias("all_int"),
            F.col(f"s{i}").alias("all_i64"),
            F.col(f"u{i}").alias("all_u64"),
            F.col(f"f{i}").alias("all_float"),
            F.col(f"b{i}").alias("all_bool"),
        ).alias(c)
        for i, c in enumerate(cols)
    ]
    long = wide.unpivot([*by, "n_rows"], values, "column_name", "_v")
    long = long.select(
        *by,
        "column_name",
        "n_rows",
        F.col("_v.column_index").alias("column_index"),
        F.col("_v.n_missing").alias("n_missing"),
        # bool_and over no rows is null: an empty column has every property
        *[F.coalesce(F.col(f"_v.{f}"), F.lit(True)).alias(f) for f in ("all_int", "all_i64", "all_u64", "all_float", "all_bool")],
    )
    return _with_first(long, df, columns, order, by, with_example, n_groups)


# --------------------------------------------------------------------------
# Public operators
# --------------------------------------------------------------------------

PROFILE_COLUMNS = (
    "column_index",
    "column_name",
    "AWS_column_dtype",
    "pandas_column_dtype",
    "example_item_list",
    "mixed_datatype_flag_list",
    "missing_data_flag_list",
    "duplicate_data_flag_list",
)


def profile(
    df: DataFrame,
    order=None,
    by: Sequence[str] = (),
    columns=None,
    na_tokens=NA_TOKENS,
    n_groups: int | None = None,
    plan: str = "rescan",
) -> DataFrame:
    """O-26: the 7-column metadata sidecar (plus ``column_index``).
    ``n_groups``: number of ``by`` groups (files) when known, see ``first_cells``;
    ``plan``: see ``column_stats``."""
    st = column_stats(df, columns, order, by, na_tokens, with_dup=True, n_groups=n_groups, plan=plan)
    return st.select(*by, *PROFILE_COLUMNS)


def profile_minimal(df: DataFrame, order=None, by: Sequence[str] = (), columns=None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-27: name, tag, dtype and example; skips the distinct pass."""
    st = column_stats(df, columns, order, by, na_tokens, with_dup=False)
    return st.select(*by, "column_index", "column_name", "AWS_column_dtype", "pandas_column_dtype", "example_item_list")


def infer_types(df: DataFrame, by: Sequence[str] = (), columns=None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-20: inferred pandas dtype of each column."""
    st = column_stats(df, columns, None, by, na_tokens, with_dup=False, with_example=False)
    return st.select(*by, "column_index", "column_name", "pandas_column_dtype")


def null_counts(df: DataFrame, by: Sequence[str] = (), columns=None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-22 (and O-21 as ``missing_data_flag_list``): missing cells per column,
    as one map-side aggregate with one counter per column."""
    by = list(by)
    cols = _value_columns(df, columns, by)
    df = ensure_parallelism(df)
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(F.col(f"`{c}`").cast("string"), na_tokens)).alias(f"m{i}") for i, c in enumerate(cols)],
    )
    values = [F.struct(F.lit(i).alias("column_index"), F.col(f"m{i}").alias("null_count")).alias(c) for i, c in enumerate(cols)]
    long = wide.unpivot([*by, "n_rows"], values, "column_name", "_v")
    return long.select(
        *by,
        F.col("_v.column_index").alias("column_index"),
        "column_name",
        F.col("_v.null_count").alias("null_count"),
        (F.col("_v.null_count") > 0).alias("missing_data_flag_list"),
        "n_rows",
    )


def missing_flags(df: DataFrame, by: Sequence[str] = (), columns=None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-21: any missing cell per column."""
    return null_counts(df, by, columns, na_tokens).select(*by, "column_index", "column_name", "missing_data_flag_list")


def duplicate_flags(df: DataFrame, by: Sequence[str] = (), columns=None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-23: a present value occurs twice (typed compare; missing cells are
    not duplicates of each other)."""
    st = column_stats(df, columns, None, by, na_tokens, with_dup=True, with_example=False)
    return st.select(*by, "column_index", "column_name", "duplicate_data_flag_list")


def mixed_flags(df: DataFrame, by: Sequence[str] = (), columns=None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-24: the reference rule: every ``object`` (text) column is mixed."""
    st = column_stats(df, columns, None, by, na_tokens, with_dup=False, with_example=False)
    return st.select(*by, "column_index", "column_name", "mixed_datatype_flag_list")


def example_items(df: DataFrame, order=None, by: Sequence[str] = (), columns=None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-25: the first row's cell of each column, printed by column type."""
    st = column_stats(df, columns, order, by, na_tokens, with_dup=False)
    return st.select(*by, "column_index", "column_name", "example_item_list")


def primary_key_flags(
    df: DataFrame, key: str | None = None, by: Sequence[str] = (), strict: bool = True, na_tokens=NA_TOKENS
) -> DataFrame:
    """O-28: the three key tests on the key column (default: first column).

    ``strict=True`` is the reference rule (a text key is "mixed");
    ``strict=False`` accepts a uniformly typed text key (decision D1).
    """
    by = list(by)
    if key is None:
        key = [c for c in df.columns if c not in set(by)][0]
    # One column, no example: reading once and shuffling the distinct keys a
    # second time was measured faster than the re-read plan here.
    st = column_stats(df, [key], None, by, na_tokens, with_dup=True, with_example=False, plan="one_scan")
    mixed = F.col("mixed_datatype_flag_list") if strict else F.lit(False)
    flags = F.array_compact(
        F.array(
            F.when(mixed, F.lit(KEY_FLAG_NAMES[0])),
            F.when(F.col("missing_data_flag_list"), F.lit(KEY_FLAG_NAMES[1])),
            F.when(F.col("duplicate_data_flag_list"), F.lit(KEY_FLAG_NAMES[2])),
        )
    )
    return st.select(
        *by,
        "column_name",
        mixed.alias("mixed_datatype_flag"),
        F.col("missing_data_flag_list").alias("missing_data_flag"),
        F.col("duplicate_data_flag_list").alias("duplicate_data_flag"),
        flags.alias("warning_flags"),
    )


class PrimaryKeyError(ValueError):
    """Raised when the key column fails a key test (reference code 430)."""

    code = 430


def require_primary_key(df: DataFrame, key: str | None = None, strict: bool = True) -> None:
    """O-29: raise when the key column fails any test (one tiny result row)."""
    row = primary_key_flags(df, key, strict=strict).first()
    if row is not None and row["warning_flags"]:
        raise PrimaryKeyError(f"column {row['column_name']!r} cannot be the primary key: {list(row['warning_flags'])}")


def duplicate_keys(df: DataFrame, key: str | None = None, count_name: str = "n") -> DataFrame:
    """O-29 report: key values that occur more than once, with their count."""
    if key is None:
        key = df.columns[0]
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def row_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """O-36: rows per file (or per any grouping)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
