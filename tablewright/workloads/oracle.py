"""Brute-force SQL (DuckDB dialect) for the registered queries.

These are written as a plain SQL user would state each rule, independent of
the Spark plans: per-column ``UNION ALL`` of cells, regex tests with
``regexp_full_match``, and ``count(DISTINCT typed value)`` for duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.patterns import (
    BOOL_PATTERN,
    FLOAT_PATTERN,
    INT64_MAX,
    INT64_MIN,
    INT_PATTERN,
    NA_TOKENS,
    UINT64_MAX,
)
from .common import sql_str

_TOKENS = ", ".join(sql_str(t) for t in NA_TOKENS)


def _strip(x: str) -> str:
    return f"trim({x}, chr(32) || chr(9))"


def _dtype_case() -> str:
    return """CASE
        WHEN n_rows = 0 THEN 'object'
        WHEN n_rows - n_missing = 0 THEN 'float64'
        WHEN all_bool THEN CASE WHEN n_missing > 0 THEN 'object' ELSE 'bool' END
        WHEN all_int AND all_i64 THEN CASE WHEN n_missing > 0 THEN 'float64' ELSE 'int64' END
        WHEN all_int AND all_u64 THEN CASE WHEN n_missing > 0 THEN 'float64' ELSE 'uint64' END
        WHEN all_int THEN 'object'
        WHEN all_float THEN 'float64'
        ELSE 'object' END"""


def _tag_case(x: str) -> str:
    return (
        f"CASE {x} WHEN 'object' THEN 'S' WHEN 'int64' THEN 'N' WHEN 'float64' THEN 'N' "
        f"WHEN 'uint64' THEN 'N' WHEN 'bool' THEN 'BOOL' WHEN 'datetime64' THEN 'S' END"
    )


def text_table_sql(source: str, columns: Sequence[str], order_col: str | None, nulls: dict | None = None) -> str:
    """``SELECT`` giving the source as text columns ``c0…`` plus ``o``."""
    nulls = nulls or {}
    parts = [f"{order_col} AS o" if order_col else "0 AS o"]
    for i, c in enumerate(columns):
        x = f"CAST({c} AS VARCHAR)"
        if c in nulls:
            x = f"nullif({x}, {sql_str(nulls[c])})"
        parts.append(f"{x} AS c{i}")
    return f"SELECT {', '.join(parts)} FROM {source}"


def cells_sql(columns: Sequence[str], by: Sequence[str] = ()) -> str:
    by_sel = "".join(f"{b}, " for b in by)
    return "\nUNION ALL\n".join(
        f"SELECT {by_sel}{i} AS column_index, {sql_str(c)} AS column_name, o, c{i} AS cell FROM t" for i, c in enumerate(columns)
    )


def profile_sql(
    text_sql: str,
    columns: Sequence[str],
    by: Sequence[str] = (),
    minimal: bool = False,
) -> str:
    """The 7-column profile by brute force (``minimal`` -> 4 columns)."""
    keys = ", ".join([*by, "column_index", "column_name"])
    by_sel = "".join(f"{b}, " for b in by)
    s = _strip("cell")
    fs = _strip("first_cell")
    dup_cols = (
        ""
        if minimal
        else """,
    count(*) FILTER (WHERE NOT m) AS n_present,
    count(DISTINCT iv) FILTER (WHERE NOT m) AS nd_int,
    count(DISTINCT dv) FILTER (WHERE NOT m) AS nd_float,
    count(DISTINCT lower(cell)) FILTER (WHERE NOT m) AS nd_bool,
    count(DISTINCT cell) FILTER (WHERE NOT m) AS nd_text"""
    )
    dup_out = (
        ""
        if minimal
        else """,
  CASE WHEN vtype IN ('int64', 'uint64') THEN n_present > nd_int
       WHEN vtype = 'float64' THEN n_present > nd_float
       WHEN vtype = 'bool' THEN n_present > nd_bool
       ELSE n_present > nd_text END AS duplicate_data_flag_list"""
    )
    mixed_etc = (
        """,
  dtype = 'object' AS mixed_datatype_flag_list,
  n_missing > 0 AS missing_data_flag_list"""
        if not minimal
        else ""
    )
    return f"""
WITH t AS ({text_sql}),
cells AS ({cells_sql(columns, by)}),
f AS (
  SELECT *,
    (cell IS NULL OR cell IN ({_TOKENS})) AS m,
    regexp_full_match(cell, {sql_str(INT_PATTERN)}) AS isint,
    TRY_CAST({s} AS HUGEINT) AS iv,
    TRY_CAST({s} AS DOUBLE) AS dv
  FROM cells
),
st AS (
  SELECT {keys},
    count(*) AS n_rows,
    count(*) FILTER (WHERE m) AS n_missing,
    bool_and(m OR isint) AS all_int,
    bool_and(m OR (isint AND iv BETWEEN {INT64_MIN} AND {INT64_MAX})) AS all_i64,
    bool_and(m OR (isint AND iv BETWEEN 0 AND {UINT64_MAX})) AS all_u64,
    bool_and(m OR regexp_full_match(cell, {sql_str(FLOAT_PATTERN)})) AS all_float,
    bool_and(m OR regexp_full_match(cell, {sql_str(BOOL_PATTERN)})) AS all_bool,
    first(cell ORDER BY o) AS first_cell{dup_cols}
  FROM f GROUP BY {keys}
),
d AS (
  SELECT *, {_dtype_case()} AS dtype FROM st
),
e AS (
  SELECT *, CASE WHEN n_rows - n_missing > 0 AND all_bool THEN 'bool' ELSE dtype END AS vtype FROM d
)
SELECT {by_sel}column_index, column_name,
  {_tag_case('dtype')} AS AWS_column_dtype,
  dtype AS pandas_column_dtype,
  CASE WHEN first_cell IS NULL OR first_cell IN ({_TOKENS}) THEN NULL
       WHEN vtype IN ('int64', 'uint64') THEN CAST(TRY_CAST({fs} AS HUGEINT) AS VARCHAR)
       WHEN vtype = 'float64' THEN CAST(TRY_CAST({fs} AS DOUBLE) AS VARCHAR)
       WHEN vtype = 'bool' THEN CASE WHEN lower(first_cell) = 'true' THEN 'True' ELSE 'False' END
       ELSE first_cell END AS example_item_list{mixed_etc}{dup_out}
FROM e
"""


def union_first_columns_sql(tables_first: Sequence[tuple[str, str]]) -> str:
    """Text of the first column of every table, tagged by table name."""
    return "\nUNION ALL\n".join(
        f"SELECT {sql_str(t)} AS table_name, {sql_str(c)} AS key_column, 0 AS o, CAST({c} AS VARCHAR) AS c0 FROM {t}"
        for t, c in tables_first
    )


def pk_flags_sql(tables_first: Sequence[tuple[str, str]]) -> str:
    inner = profile_sql(union_first_columns_sql(tables_first), ["key"], by=["table_name", "key_column"])
    return f"""
SELECT table_name, key_column,
  mixed_datatype_flag_list AS mixed_datatype_flag,
  missing_data_flag_list AS missing_data_flag,
  duplicate_data_flag_list AS duplicate_data_flag,
  concat_ws(',',
    CASE WHEN mixed_datatype_flag_list THEN 'mixed_datatype_flag' END,
    CASE WHEN missing_data_flag_list THEN 'missing_data_flag' END,
    CASE WHEN duplicate_data_flag_list THEN 'duplicate_data_flag' END) AS warning_flags
FROM ({inner}) p
"""


def null_counts_sql(text_sql: str, columns: Sequence[str]) -> str:
    return f"""
WITH t AS ({text_sql}),
cells AS ({cells_sql(columns)})
SELECT column_index, column_name,
  count(*) FILTER (WHERE cell IS NULL OR cell IN ({_TOKENS})) AS null_count,
  count(*) FILTER (WHERE cell IS NULL OR cell IN ({_TOKENS})) > 0 AS missing_data_flag_list,
  count(*) AS n_rows
FROM cells GROUP BY column_index, column_name
"""
