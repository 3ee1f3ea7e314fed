"""Registered queries: each reads the driver tables (whole) and exercises
one or more operators; ``ORACLE`` holds the matching brute-force SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window

from ..functions.cells import base_name, parse_collection
from ..operators import items as I
from ..operators import ordinal as K
from ..operators import profile as P
from ..operators import sets as T
from ..operators import split as S
from ..operators import upsert as U
from ..sinks import ledger as L
from ..session import scratch_path
from ..sinks.tables import read_table
from ..sources import catalog as C
from ..sources import delimited as D
from ..streaming.ingest import ingest_stream
from . import oracle as O
from .common import (
    EXISTING_SQL,
    LEDGER_SQL,
    LISTING_SQL,
    as_text,
    existing_tables,
    ledger_rows,
    listing,
    table,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENTS_NULLS = {"event_type": "error"}


@register(
    "profile_events",
    O.profile_sql(O.text_table_sql("events", EVENTS_COLS, "event_id", EVENTS_NULLS), EVENTS_COLS),
)
def profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-16, O-18, O-20…O-26: the full profile of ``events`` read as text,
    with ``event_type = 'error'`` made a missing cell; file order = event_id."""
    ev = as_text(table(spark, sf_dir, "events"), order_col="event_id", nulls=EVENTS_NULLS)
    return P.profile(ev, order="_o", columns=EVENTS_COLS)


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register(
    "profile_minimal_orders",
    O.profile_sql(O.text_table_sql("orders", ORDERS_COLS, "o_orderkey"), ORDERS_COLS, minimal=True),
)
def profile_minimal_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-27: name, tag, dtype and example of every ``orders`` column (one
    map-side aggregate, no value shuffle)."""
    o = as_text(table(spark, sf_dir, "orders"), order_col="o_orderkey")
    return P.profile_minimal(o, order="_o", columns=ORDERS_COLS)


DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
DOC_NULLS = {"lang": "fr"}


@register("null_counts_documents", O.null_counts_sql(O.text_table_sql("documents", DOC_COLS, None, DOC_NULLS), DOC_COLS))
def null_counts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-18, O-21, O-22: missing cells per column of ``documents`` (whole
    texts) with ``lang = 'fr'`` made missing."""
    d = as_text(table(spark, sf_dir, "documents"), nulls=DOC_NULLS)
    return P.null_counts(d, columns=DOC_COLS)


FIRST_COLUMNS = [
    ("region", "r_regionkey"),
    ("nation", "n_nationkey"),
    ("customer", "c_custkey"),
    ("supplier", "s_suppkey"),
    ("part", "p_partkey"),
    ("orders", "o_orderkey"),
    ("lineitem", "l_orderkey"),
    ("events", "event_id"),
    ("documents", "doc_id"),
    ("embeddings", "vec_id"),
    ("pages", "page_id"),
    ("benchmark", "item_id"),
    ("labels", "doc_id"),
    ("conversations", "conv_id"),
]


@register("pk_flags_all_tables", O.pk_flags_sql(FIRST_COLUMNS))
def pk_flags_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-28, O-35: the key tests on the first column of every table, as one
    grouped job over the union of all key cells."""
    from functools import reduce

    from pyspark.sql import functions as F

    parts = [
        table(spark, sf_dir, t).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("key_column"), F.col(c).cast("string").alias("key")
        )
        for t, c in FIRST_COLUMNS
    ]
    keys = reduce(DataFrame.unionAll, parts)
    flags = P.primary_key_flags(keys, key="key", by=["table_name", "key_column"])
    return flags.select(
        "table_name",
        "key_column",
        "mixed_datatype_flag",
        "missing_data_flag",
        "duplicate_data_flag",
        F.concat_ws(",", "warning_flags").alias("warning_flags"),
    )


@register(
    "duplicate_keys_lineitem",
    "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
)
def duplicate_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-29 report: key values of ``lineitem`` that repeat."""
    return P.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


LINEITEM_COLS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


@register(
    "row_key_lineitem",
    f"SELECT row_number() OVER (ORDER BY {', '.join(LINEITEM_COLS)}) AS Row_Number, * FROM lineitem",
)
def row_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-30, O-31: 1-based ``Row_Number`` first column, ordered by whole rows
    (the key alone is not unique), numbered without a one-partition window."""
    return K.add_row_key(table(spark, sf_dir, "lineitem"))


@register(
    "prefixed_key_customer",
    "SELECT 'Test_' || CAST(row_number() OVER (ORDER BY c_custkey) AS VARCHAR) AS custom_primary_key, * FROM customer",
)
def prefixed_key_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-32: ``Test_<n>`` key as the first column, in key order."""
    return K.add_prefixed_key(table(spark, sf_dir, "customer"), "Test", order="c_custkey")


ROW_RANGE = (2500, 12500)


@register(
    "row_range_orders",
    f"SELECT * FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_position, * FROM orders) "
    f"WHERE row_position >= {ROW_RANGE[0]} AND row_position < {ROW_RANGE[1]}",
)
def row_range_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-17: the half-open positional slice [2500, 12500) of ``orders`` in key
    order, with its position (the slice is the feature)."""
    out = K.row_range(table(spark, sf_dir, "orders"), "o_orderkey", *ROW_RANGE, ordinal_name="row_position")
    cols = [c for c in out.columns if c != "row_position"]
    return out.select("row_position", *cols)


# --------------------------------------------------------------------------
# Sidecar projection, items and collections
# --------------------------------------------------------------------------

PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@register(
    "apply_metadata_part",
    "SELECT CAST(p_partkey AS BIGINT) AS P_PARTKEY, p_name AS P_NAME, p_brand AS P_BRAND, "
    "p_type AS P_TYPE, CAST(p_size AS BIGINT) AS P_SIZE FROM part",
)
def apply_metadata_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-12, O-16: a sidecar made by profiling ``part`` read as text, renamed
    (upper case) and one column short, applied by position: names, types,
    and the trailing column dropped."""
    from pyspark.sql import functions as F

    text = as_text(table(spark, sf_dir, "part"))
    meta = (
        P.profile_minimal(text, columns=PART_COLS)
        .filter(F.col("column_index") < len(PART_COLS) - 1)
        .withColumn("column_name", F.upper("column_name"))
    )
    return I.apply_metadata(text, meta)


@register(
    "tagged_cells_events",
    "\nUNION ALL\n".join(
        f"SELECT CAST(event_id AS VARCHAR) AS event_id, '{c}' AS attribute, '{t}' AS tag, {v} AS value "
        f"FROM events WHERE {v} IS NOT NULL"
        for c, t, v in [
            ("event_id", "N", "CAST(event_id AS VARCHAR)"),
            ("ts", "S", "CAST(ts AS VARCHAR)"),
            ("user_id", "N", "CAST(user_id AS VARCHAR)"),
            ("event_type", "S", "nullif(event_type, 'error')"),
            ("value", "N", "CAST(value AS VARCHAR)"),
            ("props", "S", "props"),
        ]
    ),
)
def tagged_cells_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-13, O-14: every present cell of ``events`` as (key, attribute, tag,
    value) with the tags the profile infers; missing cells are left out."""
    ev = as_text(table(spark, sf_dir, "events"), nulls=EVENTS_NULLS)
    meta = P.profile_minimal(ev, columns=EVENTS_COLS)
    return I.tagged_cells(ev, meta)


@register(
    "parse_map_props",
    "SELECT event_id, k AS key, json_extract_string(props, '$.\"' || k || '\"') AS value "
    "FROM events, unnest(json_keys(props)) AS t(k)",
)
def parse_map_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-15 (``M``): the JSON object in ``events.props`` as a map, exploded."""
    from pyspark.sql import functions as F

    ev = table(spark, sf_dir, "events")
    m = ev.select("event_id", parse_collection(F.col("props"), "M").alias("m"))
    return m.select("event_id", F.explode("m").alias("key", "value"))


@register(
    "parse_set_part_name",
    "SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS element FROM part",
)
def parse_set_part_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-15 (``SS``): ``p_name`` written as a quoted string set
    (``'small','ring'``), parsed to a distinct array and exploded."""
    from pyspark.sql import functions as F

    part = table(spark, sf_dir, "part")
    quoted = F.concat(F.lit("'"), F.regexp_replace("p_name", " ", "','"), F.lit("'"))
    s = part.select("p_partkey", parse_collection(quoted, "SS").alias("s"))
    return s.select("p_partkey", F.explode("s").alias("element"))


# --------------------------------------------------------------------------
# Splitting
# --------------------------------------------------------------------------

THRESHOLD = 10000


@register(
    "split_plan_all",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, n AS n_rows, (SELECT CAST(min(k) AS INTEGER) FROM range(0, 65) r(k) "
        f"WHERE n / pow(2, k) + k <= {THRESHOLD}) AS halvings, (SELECT CAST(min(k) AS INTEGER) FROM range(0, 65) r(k) "
        f"WHERE n * 1000 / pow(2, k) + k <= {THRESHOLD}) AS halvings_1000 FROM (SELECT count(*) AS n FROM {t})"
        for t, _ in [("region", 0), ("nation", 0), ("customer", 0), ("supplier", 0), ("part", 0), ("orders", 0),
                     ("lineitem", 0), ("events", 0), ("documents", 0), ("embeddings", 0), ("pages", 0),
                     ("benchmark", 0), ("labels", 0), ("conversations", 0)]
    ),
)
def split_plan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-36, O-40: rows of every table and the halvings its split needs at
    the default threshold (n <= threshold is one part), and would need with a
    thousand times the rows."""
    from functools import reduce

    from pyspark.sql import functions as F

    from .common import TABLES

    counts = reduce(
        DataFrame.unionAll,
        [table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in TABLES],
    )
    return counts.select(
        "table_name",
        "n_rows",
        S.split_plan_col("n_rows", THRESHOLD).alias("halvings"),
        S.split_plan_col(F.col("n_rows") * 1000, THRESHOLD).alias("halvings_1000"),
    )


SPLIT_PARTS_SQL = f"""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM lineitem),
k AS (SELECT (SELECT min(k) FROM range(0, 65) r(k) WHERE n / pow(2, k) + k <= {THRESHOLD}) AS k FROM n),
parts(lo, hi, depth, part) AS (
  SELECT 0::BIGINT, n, 0, 1::BIGINT FROM n
  UNION ALL
  SELECT CASE WHEN s.side = 1 THEN p.lo ELSE p.lo + greatest((p.hi - p.lo) // 2 - 1, 0) END,
         CASE WHEN s.side = 1 THEN p.lo + greatest((p.hi - p.lo) // 2 - 1, 0) ELSE p.hi END,
         p.depth + 1,
         CASE WHEN s.side = 1 THEN p.part * 2 - 1 ELSE p.part * 2 END
  FROM parts p, (VALUES (1), (2)) s(side), k WHERE p.depth < k.k
),
leaf AS (SELECT lo, hi, part FROM parts, k WHERE depth = k.k),
ord AS (SELECT row_number() OVER (ORDER BY {', '.join(LINEITEM_COLS)}) - 1 AS pos FROM lineitem)
SELECT CAST(leaf.part AS INTEGER) AS part, printf('lineitem_split__%03d.csv', leaf.part) AS part_name,
       count(*) AS n_rows, min(pos) AS first_row, max(pos) AS last_row
FROM ord JOIN leaf ON ord.pos >= leaf.lo AND ord.pos < leaf.hi
GROUP BY leaf.part
"""


@register("split_parts_lineitem", SPLIT_PARTS_SQL)
def split_parts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-41, O-42, O-43: ``lineitem`` (whole-row order) cut into contiguous
    parts by repeated halving; rows, first and last position per part."""
    from pyspark.sql import functions as F

    li = table(spark, sf_dir, "lineitem")
    parts = S.assign_parts(li, None, THRESHOLD, ordinal_col="pos")
    names = F.format_string("lineitem_split__%03d.csv", F.col("part"))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("pos").alias("first_row"), F.max("pos").alias("last_row")
    ).select(F.col("part").cast("int").alias("part"), names.alias("part_name"), "n_rows", "first_row", "last_row")


# --------------------------------------------------------------------------
# Sets and upsert
# --------------------------------------------------------------------------


@register(
    "combine_parts_customer_supplier",
    "SELECT 'part1' AS part, c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, "
    "c_mktsegment AS mktsegment FROM customer "
    "UNION ALL BY NAME "
    "SELECT 'part2' AS part, s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier",
)
def combine_parts_customer_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-50: two parts of one table, the second lacking a column, appended by
    column name in part-name order."""
    from pyspark.sql import functions as F

    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"),
    )
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return T.combine_parts([s, c], ["part2", "part1"], part_col="part")


UPSERT_SQL = """
WITH b AS (
  SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal, o_orderpriority AS c_mktsegment,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
), last AS (SELECT c_custkey, c_acctbal, c_mktsegment FROM b WHERE rn = 1)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM last WHERE last.c_custkey = customer.c_custkey)
UNION ALL
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, CAST(NULL AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment FROM last
"""


@register("upsert_customer", UPSERT_SQL)
def upsert_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-61: every order puts an item (key, balance, segment) into
    ``customer``; keys repeat in the batch, the last order (date, key) wins,
    and a put replaces the whole item, so name and nation become empty."""
    from pyspark.sql import functions as F

    cust = table(spark, sf_dir, "customer")
    batch = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"), "o_orderdate", "o_orderkey",
    )
    return U.upsert(cust, batch, "c_custkey", order=["o_orderdate", "o_orderkey"])


# --------------------------------------------------------------------------
# Catalogue, ledger, report
# --------------------------------------------------------------------------

CATALOG_SQL = f"""
WITH listing AS ({LISTING_SQL}),
c1 AS (SELECT path, n_rows, regexp_extract(path, '([^/]*)$', 1) AS name FROM listing),
c2 AS (SELECT *, starts_with(name, 'metadata_') AS is_metadata,
              CASE WHEN starts_with(name, 'metadata_') THEN substr(name, 10) ELSE name END AS data_name FROM c1),
catalog AS (SELECT *, regexp_replace(data_name, '(_split__[0-9]{{3,}})?[.]csv$', '') AS table_name,
             CAST(nullif(regexp_extract(data_name, '_split__([0-9]{{3,}})[.]csv$', 1), '') AS BIGINT) AS part FROM c2),
ledger AS ({LEDGER_SQL}),
existing AS ({EXISTING_SQL})
"""


def _catalog(spark, sf_dir):
    return C.catalog_from_paths(listing(spark, sf_dir).withColumn("length", _null_long()))


def _null_long():
    from pyspark.sql import functions as F

    return F.lit(None).cast("long")


@register(
    "catalog_names",
    CATALOG_SQL + "SELECT path, name, is_metadata, data_name, table_name, part FROM catalog",
)
def catalog_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-03, O-06: classify every landed file (sidecar or data, table, part)."""
    return _catalog(spark, sf_dir).select("path", "name", "is_metadata", "data_name", "table_name", "part")


@register("tables_to_load", CATALOG_SQL + "SELECT DISTINCT table_name FROM catalog WHERE NOT is_metadata")
def tables_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-07: distinct table names of the data files."""
    return C.tables_to_load(_catalog(spark, sf_dir))


@register(
    "invalid_table_names",
    CATALOG_SQL
    + "SELECT DISTINCT table_name FROM catalog WHERE NOT is_metadata AND NOT regexp_full_match(table_name, '[A-Za-z0-9_.-]{3,255}')",
)
def invalid_table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-09: table names the key-value store would refuse."""
    return C.invalid_table_names(_catalog(spark, sf_dir))


@register(
    "files_without_metadata",
    CATALOG_SQL
    + "SELECT path, name, table_name FROM catalog d WHERE NOT is_metadata AND NOT EXISTS "
    "(SELECT 1 FROM catalog m WHERE m.is_metadata AND m.data_name = d.name)",
)
def files_without_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-08: data files that still need a generated sidecar."""
    return C.files_without_metadata(_catalog(spark, sf_dir)).select("path", "name", "table_name")


@register(
    "name_collisions",
    CATALOG_SQL
    + "SELECT DISTINCT table_name FROM catalog c WHERE NOT is_metadata AND EXISTS "
    "(SELECT 1 FROM existing e WHERE e.table_name = c.table_name)",
)
def name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-10: tables to load that already exist."""
    return C.name_collisions(_catalog(spark, sf_dir), existing_tables(spark, sf_dir))


@register(
    "tables_to_create",
    CATALOG_SQL
    + "SELECT DISTINCT table_name FROM catalog c WHERE NOT is_metadata AND NOT EXISTS "
    "(SELECT 1 FROM existing e WHERE e.table_name = c.table_name)",
)
def tables_to_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-11: tables to load that must be created first."""
    return C.tables_to_create(_catalog(spark, sf_dir), existing_tables(spark, sf_dir))


@register(
    "remaining_files",
    CATALOG_SQL
    + "SELECT path, table_name FROM catalog c WHERE NOT is_metadata AND NOT EXISTS "
    "(SELECT 1 FROM ledger l WHERE l.path = c.path AND l.status = 'done')",
)
def remaining_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-71: data files a rerun still has to load."""
    return C.remaining_files(_catalog(spark, sf_dir), ledger_rows(spark, sf_dir)).select("path", "table_name")


@register(
    "run_report",
    CATALOG_SQL
    + """, st AS (SELECT path, CASE WHEN bool_or(status = 'done') THEN 'done' ELSE 'failed' END AS status
               FROM ledger GROUP BY path)
SELECT table_name, coalesce(st.status, 'pending') AS status, count(*) AS n_files, CAST(sum(n_rows) AS BIGINT) AS n_rows
FROM catalog c LEFT JOIN st USING (path) WHERE NOT is_metadata GROUP BY 1, 2""",
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-70, O-72: files and rows per table: done, failed, still to go."""
    return L.run_report(_catalog(spark, sf_dir), ledger_rows(spark, sf_dir))


# --------------------------------------------------------------------------
# Round trips through files (written under the shared checkpoint folder)
# --------------------------------------------------------------------------

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _write_csv(df: DataFrame, path: str, encoding: str | None = None) -> None:
    w = (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if encoding:
        w = w.option("encoding", encoding)
    w.csv(path)


@register(
    "csv_roundtrip_customer",
    O.profile_sql(O.text_table_sql("customer", CUSTOMER_COLS, "c_custkey"), CUSTOMER_COLS),
)
def csv_roundtrip_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-01, O-26: ``customer`` written as CSV files in key order, read back
    (all text, names from the header, file order kept) and profiled."""
    from pyspark.sql import functions as F

    path = scratch_path(spark, "csv-customer")
    _write_csv(table(spark, sf_dir, "customer").orderBy("c_custkey"), path)
    df = D.read_delimited(spark, path, file_order=True)
    return P.profile(df, order=[F.col(c) for c in D.FILE_ORDER], columns=CUSTOMER_COLS)


@register(
    "write_parts_lineitem",
    SPLIT_PARTS_SQL.replace(
        f"ord AS (SELECT row_number() OVER (ORDER BY {', '.join(LINEITEM_COLS)}) - 1 AS pos FROM lineitem)",
        f"ord AS (SELECT row_number() OVER (ORDER BY {', '.join(LINEITEM_COLS)}) - 1 AS pos, l_orderkey, l_partkey, l_suppkey FROM lineitem)",
    ).replace(
        "count(*) AS n_rows, min(pos) AS first_row, max(pos) AS last_row",
        "CAST(pos - leaf.lo AS BIGINT) AS place, CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, "
        "CAST(l_suppkey AS VARCHAR) AS l_suppkey",
    ).replace("GROUP BY leaf.part", "").replace("CAST(leaf.part AS INTEGER) AS part, ", ""),
)
def write_parts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-43, O-44: ``lineitem`` written as CSV part files under the row
    threshold, read back with every row's part name and place in its part."""
    from pyspark.sql import functions as F

    path = scratch_path(spark, "parts-lineitem")
    parts = S.write_parts(table(spark, sf_dir, "lineitem"), path, THRESHOLD, table="lineitem").select(F.col("path").alias(D.FILE_COL), F.col("name").alias("part_name"))
    back = D.read_delimited(spark, [r[0] for r in parts.collect()], file_order=True).join(parts, D.FILE_COL)
    starts = back.groupBy("part_name", D.FILE_COL, D.BLOCK_COL).agg(F.count(F.lit(1)).alias("n"), F.min(D.ROW_COL).alias("first"))
    w = Window.partitionBy("part_name").orderBy(D.FILE_COL, D.BLOCK_COL).rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("part_name")
    placed = back.join(starts, [D.FILE_COL, D.BLOCK_COL])
    return placed.select(
        "part_name",
        (F.col("before") + F.col(D.ROW_COL) - F.col("first")).alias("place"),
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
    )


CUSTOMER_META = [
    ("c_custkey", "N", "int64"),
    ("c_name", "S", "object"),
    ("c_nationkey", "N", "int64"),
    ("c_acctbal", "N", "float64"),
    ("c_mktsegment", "S", "object"),
]


@register(
    "stream_ingest_customer",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def stream_ingest_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-73 (with O-61, O-70): ``customer`` landed as several CSV files,
    ingested by an available-now stream (one file per trigger) that upserts
    into a keyed parquet table and archives the files; the table is read
    back."""
    root = scratch_path(spark, "stream-customer")
    _write_csv(table(spark, sf_dir, "customer").repartition(4), f"{root}/landing")
    ingest_stream(
        spark,
        f"{root}/landing",
        CUSTOMER_COLS,
        f"{root}/table",
        f"{root}/checkpoint",
        f"{root}/ledger",
        meta=CUSTOMER_META,
        archive_dir=f"{root}/archive",
        max_files_per_trigger=1,
        rows_per_bucket=500,
    )
    return read_table(spark, f"{root}/table")


ENCODING_SQL = r"""
SELECT 'utf8' AS copy, lang, count(*) AS n_docs, count(*) AS n_same FROM documents GROUP BY lang
UNION ALL
SELECT 'latin1' AS copy, lang, count(*) AS n_docs,
       count(*) FILTER (WHERE regexp_full_match(text, '[\x{0}-\x{ff}]*')) AS n_same
FROM documents GROUP BY lang
"""


@register("encoding_choice_documents", ENCODING_SQL)
def encoding_choice_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-02: ``documents`` landed twice, as UTF-8 and as ISO-8859-1 files;
    each file's encoding is chosen from its bytes, each encoding group is
    read with its own scan (whole texts, multi-line fields), and every text
    read back is compared with the original: per copy and language, the
    documents and how many came back unchanged (a Latin-1 copy can only keep
    texts that Latin-1 can spell)."""
    from pyspark.sql import functions as F

    root = scratch_path(spark, "enc-documents")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    _write_csv(docs, f"{root}/utf8")
    _write_csv(docs, f"{root}/latin1", encoding="ISO-8859-1")
    back = D.read_with_encodings(spark, [f"{root}/utf8/*.csv", f"{root}/latin1/*.csv"], multi_line=True, file_order=True)
    back = back.select(
        F.when(F.col(D.FILE_COL).contains("/latin1/"), F.lit("latin1")).otherwise(F.lit("utf8")).alias("copy"),
        F.col("doc_id").alias("doc_key"),
        F.col("text").alias("text_back"),
    )
    orig = docs.select(F.col("doc_id").cast("string").alias("doc_key"), "lang", "text")
    joined = back.join(orig, on="doc_key", how="inner")
    return joined.groupBy("copy", "lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("text_back") == F.col("text")).alias("n_same"),
    )


# --------------------------------------------------------------------------
# Folder flows over landed files
# --------------------------------------------------------------------------

FOLDER_TABLES = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "customer": CUSTOMER_COLS,
}


def _land_tables(spark: SparkSession, sf_dir: str, folder: str, parts: dict[str, int]) -> None:
    from ..sinks.tables import land_as_files

    for t, cols in FOLDER_TABLES.items():
        land_as_files(spark, table(spark, sf_dir, t).select(*cols).orderBy(cols[0]), folder, t, parts.get(t))


#: Every table with all its columns (a vector is no cell of a delimited
#: file), and the columns that order its rows in the landed files.
PROFILED = {
    "region": ("r_regionkey, r_name", 1),
    "nation": ("n_nationkey, n_name, n_regionkey", 1),
    "customer": (", ".join(CUSTOMER_COLS), 1),
    "supplier": ("s_suppkey, s_name, s_nationkey, s_acctbal", 1),
    "part": ("p_partkey, p_name, p_brand, p_type, p_size, p_retailprice", 1),
    "orders": (", ".join(ORDERS_COLS), 1),
    "lineitem": (", ".join(LINEITEM_COLS), len(LINEITEM_COLS)),
    "events": (", ".join(EVENTS_COLS), 1),
    "documents": ("doc_id, text, lang, source, n_chars", 1),
    "embeddings": ("vec_id, label", 1),
    "pages": ("page_id, url, html", 1),
    "benchmark": ("item_id, text", 1),
    "labels": ("doc_id, quality, toxic", 1),
    "conversations": ("conv_id, turn, role, text", 4),
}


def _profile_folder_sql() -> str:
    parts = []
    for t, (names, n_order) in PROFILED.items():
        cols = names.split(", ")
        inner = O.profile_sql(O.text_table_sql(t, cols, f"row({', '.join(cols[:n_order])})"), cols)
        parts.append(
            f"SELECT '{t}' AS table_name, column_index, column_name, AWS_column_dtype, pandas_column_dtype, "
            f"example_item_list, mixed_datatype_flag_list, missing_data_flag_list, duplicate_data_flag_list FROM ({inner})"
        )
    return "\nUNION ALL\n".join(parts)


@register("profile_folder_tables", _profile_folder_sql())
def profile_folder_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-35 (with O-01…O-03, O-26, O-28): all tables landed as ordered CSV
    files (one or more parts each) in one folder, each profiled as a whole
    in file order in one grouped job per table, with its key warnings. Texts
    keep their quoted line breaks."""
    from ..plans.folder import profile_folder
    from ..sinks.tables import land_as_files

    root = scratch_path(spark, "folder-profile")
    for t, (names, n_order) in PROFILED.items():
        cols = names.split(", ")
        ordered = table(spark, sf_dir, t).select(*cols).orderBy(*cols[:n_order])
        land_as_files(spark, as_text(ordered), root, t)
    prof = profile_folder(spark, root, per_file=False, multi_line=True)
    return prof.select(
        "table_name", "column_index", "column_name", "AWS_column_dtype", "pandas_column_dtype", "example_item_list",
        "mixed_datatype_flag_list", "missing_data_flag_list", "duplicate_data_flag_list",
    )


@register(
    "load_folder_customer",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def load_folder_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-65 (with O-03, O-07…O-11, O-28/29, O-26, O-12, O-60, O-61, O-70/72):
    a folder with ``customer`` landed in three parts plus three single-file
    tables is loaded into keyed parquet tables; ``customer`` is read back."""
    from ..options import LoadOptions
    from ..plans.folder import load_folder

    root = scratch_path(spark, "folder-load")
    _land_tables(spark, sf_dir, f"{root}/landing", {"customer": 3})
    report = load_folder(spark, LoadOptions(input_path=f"{root}/landing", output_path=f"{root}/warehouse"))
    bad = [r for r in report.collect() if r["status"] != "done"]
    if bad:
        raise RuntimeError(f"load did not finish: {bad}")
    return read_table(spark, f"{root}/warehouse/customer")


ORDERS_PART_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@register("union_load_new_orders", f"SELECT {', '.join(ORDERS_PART_COLS)}, o_orderdate FROM orders")
def union_load_new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-51, O-62 (with O-01): ``orders`` landed as four CSV parts, read as
    one table by a single multi-path scan, written with ``load_new`` (fails
    if the table exists) and read back; integers typed again."""
    from pyspark.sql import functions as F

    from ..sinks.tables import land_as_files, load_new

    root = scratch_path(spark, "union-load-new")
    paths = land_as_files(spark, table(spark, sf_dir, "orders").select(*ORDERS_PART_COLS, "o_orderdate"), f"{root}/landing", "orders", 4)
    whole = T.union_table(spark, paths)
    load_new(whole, f"{root}/tables/orders")
    back = spark.read.parquet(f"{root}/tables/orders")
    return back.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderpriority",
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
    )


def _sidecar_text_sql() -> str:
    inner = O.profile_sql(O.text_table_sql("events", EVENTS_COLS, "event_id", EVENTS_NULLS), EVENTS_COLS)
    return (
        "SELECT column_index, column_name, AWS_column_dtype, pandas_column_dtype, example_item_list, "
        "lower(CAST(mixed_datatype_flag_list AS VARCHAR)) AS mixed_datatype_flag_list, "
        "lower(CAST(missing_data_flag_list AS VARCHAR)) AS missing_data_flag_list, "
        f"lower(CAST(duplicate_data_flag_list AS VARCHAR)) AS duplicate_data_flag_list FROM ({inner})"
    )


@register("metadata_roundtrip_events", _sidecar_text_sql())
def metadata_roundtrip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-63, O-04: the ``events`` profile written as a sidecar CSV and read
    back (all text, line order as ``column_index``)."""
    from pyspark.sql import functions as F

    from ..sinks.tables import write_metadata

    ev = as_text(table(spark, sf_dir, "events"), order_col="event_id", nulls=EVENTS_NULLS)
    path = scratch_path(spark, "sidecar-events")
    write_metadata(P.profile(ev, order="_o", columns=EVENTS_COLS), path)
    back = D.read_metadata(spark, path)
    return back.select(F.col("column_index").cast("int").alias("column_index"), *[c for c in back.columns if c != "column_index"])


@register(
    "add_key_file_customer",
    "SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS VARCHAR) AS Row_Number, CAST(c_custkey AS VARCHAR) AS c_custkey, "
    "c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer",
)
def add_key_file_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 3 (O-01, O-31, O-64): ``customer`` landed as CSV files in key
    order gets a ``Row_Number`` first column in file order (file, offset,
    row), is written to a new path and read back as text."""
    from ..plans.folder import add_key_to_file
    from ..sinks.tables import land_as_files

    root = scratch_path(spark, "add-key")
    land_as_files(spark, table(spark, sf_dir, "customer").orderBy("c_custkey"), f"{root}/in", "customer")
    add_key_to_file(spark, f"{root}/in", f"{root}/out")
    return D.read_delimited(spark, f"{root}/out")


from . import flow_queries  # noqa: E402, F401  (registers the folder flows)
