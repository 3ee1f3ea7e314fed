"""Sidecar projection and key-value items: O-12, O-13, O-14, O-15, O-16.

A sidecar (metadata) frame has one row per column, so it is small by
construction (bounded by the column count) and is read to the driver to
build a ``select`` list; the data itself never leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import double_value, float_text, int_value, is_inexact, is_missing, long_value, parse_collection, render_cell
from ..functions.patterns import NA_TOKENS

COLLECTION_TAGS = ("SS", "NS", "BS", "L", "M")


def sidecar_rows(meta: DataFrame) -> list[tuple[str, str, str | None]]:
    """(column_name, tag, pandas dtype or None) in sidecar order.

    Order is ``column_index`` when the sidecar has it, else its row order
    (a sidecar file read with one task keeps file order)."""
    cols = meta.columns
    sel = [F.col("column_name"), F.col("AWS_column_dtype")]
    sel.append(F.col("pandas_column_dtype") if "pandas_column_dtype" in cols else F.lit(None).cast("string"))
    if "column_index" in cols:
        rows = meta.select("column_index", *sel).orderBy("column_index").collect()
        return [(r[1], r[2], r[3]) for r in rows]
    return [(r[0], r[1], r[2]) for r in meta.select(*sel).collect()]


def typed_column(c, tag: str, dtype: str | None):
    """A text cell as the Spark type its tag (and dtype, if known) asks for."""
    if tag in COLLECTION_TAGS:
        return parse_collection(c, tag)
    if tag == "N":
        if dtype in ("int64", "uint64"):
            return long_value(c) if dtype == "int64" else F.when(long_value(c).isNotNull(), long_value(c).cast("decimal(20,0)")).otherwise(
                c.try_cast("decimal(20,0)")
            )
        return double_value(c)
    if tag == "BOOL":
        return F.when(F.lower(c) == "true", F.lit(True)).when(F.lower(c) == "false", F.lit(False))
    return c


def with_number_types(df: DataFrame, rows, na_tokens=NA_TOKENS) -> list[tuple]:
    """Sidecar rows in which every number column has a dtype: a sidecar
    without one (the minimal form) leaves it to the data, and whole numbers
    must keep all their digits. One pass over those columns, if there are
    any."""
    from .profile import infer_types

    data_cols = list(df.columns)[: len(rows)]
    open_ = [src for src, (_, tag, dtype) in zip(data_cols, rows) if tag == "N" and not dtype]
    if not open_:
        return list(rows)
    found = {r["column_name"]: r["pandas_column_dtype"] for r in infer_types(df.select(*[F.col(f"`{c}`") for c in open_]), columns=open_, na_tokens=na_tokens).collect()}
    numbers = {c: t if t in ("int64", "uint64", "float64") else "float64" for c, t in found.items()}
    return [(n, tag, numbers.get(src) if src in numbers else dtype) for src, (n, tag, dtype) in zip(data_cols, rows)]


def misfits(df: DataFrame, rows, na_tokens=NA_TOKENS):
    """A row's number of cells that are there but are not what the sidecar
    says they are (they would become null). A number column without a dtype
    is only held to be of numbers: ``inexact_cells`` is asked for once it is
    known to be of doubles."""
    out = F.lit(0)
    for src, (_, tag, dtype) in zip(df.columns, rows):
        if tag == "S":
            continue
        c = F.col(f"`{src}`").cast("string")
        wrong = typed_column(c, tag, dtype).isNull()
        if tag == "N" and dtype and dtype not in ("int64", "uint64"):
            wrong = wrong | is_inexact(c)
        out = out + (~is_missing(c, na_tokens) & wrong).cast("int")
    return out


def inexact_cells(columns: Sequence[str], na_tokens=NA_TOKENS):
    """A row's number of whole numbers in ``columns`` that doubles would
    round."""
    cells = [F.col(f"`{c}`").cast("string") for c in columns]
    return sum(((~is_missing(c, na_tokens) & is_inexact(c)).cast("int") for c in cells), F.lit(0))


def apply_metadata(df: DataFrame, meta: DataFrame | Sequence, na_tokens=NA_TOKENS, keep: Sequence[str] = ()) -> DataFrame:
    """O-12: rename and type the data columns from the sidecar, by position.

    A shorter sidecar drops the trailing data columns; missing cells (NA
    tokens) become nulls. ``meta`` may be a sidecar DataFrame or a list of
    ``(name, tag[, dtype])`` tuples."""
    rows = sidecar_rows(meta) if isinstance(meta, DataFrame) else [tuple(r) + (None,) * (3 - len(r)) for r in meta]
    data_cols = [c for c in df.columns if c not in set(keep)]
    if len(rows) > len(data_cols):
        raise ValueError(f"sidecar has {len(rows)} columns, data has {len(data_cols)}")
    rows = with_number_types(df.select(*[F.col(f"`{c}`") for c in data_cols]), rows, na_tokens)
    out = []
    for src, (name, tag, dtype) in zip(data_cols, rows):
        c = F.col(f"`{src}`").cast("string")
        c = F.when(is_missing(c, na_tokens), F.lit(None).cast("string")).otherwise(c)
        out.append(typed_column(c, tag, dtype).alias(name))
    return df.select(*out, *[F.col(f"`{k}`") for k in keep])


def with_rendered(df: DataFrame, sources: Sequence[str], dtypes: Sequence[str], na_tokens=NA_TOKENS) -> DataFrame:
    """``df`` with ``_v0``, ``_v1``, ...: O-13 of each source column, null for
    a missing cell. The number test, the cast and the number's text are
    columns of projections of their own, so each runs once per cell (nested
    in the branches of one expression they ran up to four times)."""
    cells = {i: F.col(f"`{c}`").cast("string") for i, c in enumerate(sources)}
    out = df.withColumns({f"_c{i}": F.when(~is_missing(c, na_tokens), c) for i, c in cells.items()})
    numbers = {"int64": long_value, "uint64": long_value, "float64": double_value}
    out = out.withColumns({f"_n{i}": numbers[t](f"_c{i}") if t in numbers else F.lit(None) for i, t in enumerate(dtypes)})
    out = out.withColumns({f"_t{i}": F.col(f"_n{i}").cast("string") for i in cells})
    values = {}
    for i, t in enumerate(dtypes):
        if t == "float64":
            v = float_text(F.col(f"_n{i}"), F.col(f"_t{i}"))
        elif t in numbers:
            v = F.when(F.col(f"_n{i}").isNotNull(), F.col(f"_t{i}")).otherwise(int_value(f"_c{i}").cast("string"))
        else:
            v = render_cell(F.col(f"_c{i}"), t)
        values[f"_v{i}"] = v
    return out.withColumns(values).drop(*[f"_{k}{i}" for k in "cnt" for i in cells])


def tagged_cells(df: DataFrame, meta: DataFrame | Sequence, key: str | None = None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-13, O-14 (long form): one row per present cell:
    ``(key, attribute, tag, value)``; missing cells are left out, values are
    printed by column type (integers without ``.0``)."""
    rows = sidecar_rows(meta) if isinstance(meta, DataFrame) else [tuple(r) + (None,) * (3 - len(r)) for r in meta]
    cols = df.columns[: len(rows)]
    key = key or cols[0]
    keyname = rows[cols.index(key)][0]
    base = with_rendered(df, cols, [dtype or ("object" if tag != "N" else "float64") for _, tag, dtype in rows[: len(cols)]], na_tokens)
    base = base.select(F.col(f"`{key}`").alias(keyname), *[f"_v{i}" for i in range(len(cols))])
    triples = ", ".join(f"{_sql_lit(n)}, {_sql_lit(t)}, `_v{i}`" for i, (n, t, _) in enumerate(rows[: len(cols)]))
    long = base.select(keyname, F.expr(f"stack({len(cols)}, {triples})").alias("attribute", "tag", "value"))
    return long.filter(F.col("value").isNotNull() & (F.col("value") != ""))


def tagged_item(df: DataFrame, meta: DataFrame | Sequence, key: str | None = None, na_tokens=NA_TOKENS) -> DataFrame:
    """O-14 (item form): ``(key, item)`` where ``item`` maps attribute ->
    struct(tag, value, BOOL, SS, NS, BS, L, M) and leaves missing cells out
    (a sparse item). ``value`` is the cell's text (numbers as printed);
    booleans, sets, lists and maps also stand in the member of their tag."""
    rows = sidecar_rows(meta) if isinstance(meta, DataFrame) else [tuple(r) + (None,) * (3 - len(r)) for r in meta]
    cols = df.columns[: len(rows)]
    key = key or cols[0]
    keyname = rows[cols.index(key)][0]
    kinds = {"BOOL": "boolean", "SS": "array<string>", "NS": "array<double>", "BS": "array<binary>", "L": "array<string>", "M": "map<string,string>"}
    df = with_rendered(df, cols, [dtype or ("object" if tag != "N" else "float64") for _, tag, dtype in rows[: len(cols)]], na_tokens)
    pairs = []
    for i, (src, (name, tag, dtype)) in enumerate(zip(cols, rows)):
        c, v = F.col(f"`{src}`").cast("string"), F.col(f"_v{i}")
        native = [(typed_column(c, tag, dtype) if t == tag else F.lit(None)).cast(kind).alias(t) for t, kind in kinds.items()]
        pairs += [F.lit(name), F.struct(F.lit(tag).alias("tag"), v.alias("value"), *native)]
    item = F.map_filter(F.create_map(*pairs), lambda k, s: s["value"].isNotNull() & (s["value"] != ""))
    return df.select(F.col(f"`{key}`").alias(keyname), item.alias("item"))


def _sql_lit(s: str) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"
