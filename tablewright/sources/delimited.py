"""Delimited-file sources: O-01, O-02, O-04, O-05.

All columns are read as text (type inference is the profile's job); names
come from the header line with pandas-style de-duplication (``a``, ``a.1``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .records import parse_records, read_records

FILE_COL = "_file"
BLOCK_COL = "_block"
ROW_COL = "_row"
FILE_ORDER = (FILE_COL, BLOCK_COL, ROW_COL)
#: The raw text of a record whose number of cells differs from the header's.
CORRUPT_COL = "_corrupt"
#: True for a record with more cells than its file's header.
RAGGED_COL = "_ragged"


def scan_path():
    """The path of a scanned file, spelled as the catalogue spells it (the
    scan's metadata is URL-encoded; without a ``%`` it is the path itself, and
    decoding it for every row is saved)."""
    path = F.col("_metadata.file_path")
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def is_ragged(n_columns: int, sep: str = ","):
    """More cells than the header (fewer are missing cells): separators
    outside quotes are counted in the records that did not fit."""
    bare = F.regexp_replace(F.col(CORRUPT_COL), '"(?:[^"]|"")*"', "")
    n_seps = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(sep), F.lit("")))
    return F.coalesce(n_seps >= n_columns * len(sep), F.lit(False))


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Duplicate header names become ``a``, ``a.1``, ``a.2`` (pandas rule);
    an empty header becomes ``Unnamed: i``."""
    out, seen = [], {}
    for i, n in enumerate(names):
        n = n if n not in (None, "") else f"Unnamed: {i}"
        if n in seen:
            k = seen[n]
            cand = f"{n}.{k}"
            while cand in seen:
                k += 1
                cand = f"{n}.{k}"
            seen[n] = k + 1
            seen[cand] = 1
            out.append(cand)
        else:
            seen[n] = 1
            out.append(n)
    return out


def _reader(spark: SparkSession, sep: str, encoding: str | None, multi_line: bool, header: bool):
    r = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )
    if encoding:
        r = r.option("encoding", encoding)
    return r


def header_names(spark: SparkSession, paths, sep: str = ",", encoding: str | None = None, multi_line: bool = False) -> list[str]:
    """Column names from the first line of the first file (one small read)."""
    first = _reader(spark, sep, encoding, multi_line, header=False).csv(_paths(paths)[0]).limit(1).collect()
    if not first:
        return []
    *names, last = first[0]
    # a line break in the header can hide from the reader how lines end
    return dedupe_names([*names, last[:-1] if multi_line and last and last.endswith("\r") else last])


def read_delimited(
    spark: SparkSession,
    paths,
    sep: str = ",",
    encoding: str | None = None,
    multi_line: bool = False,
    names: Sequence[str] | None = None,
    file_order: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """O-01: header row, quoted fields (``""`` escapes a quote), every column
    as text. Empty fields are null; other NA tokens are kept as text and
    recognised by ``is_missing``. ``file_order`` adds ``_file``, ``_block``
    and ``_row`` whose order is the file order (one split's rows are
    consecutive in ``_row``); ``corrupt`` adds ``_corrupt``, the text of
    records with more or fewer cells than the header, else null.
    ``multi_line``: quoted cells may hold line breaks; files are still read
    by many tasks (``sources.records``; one pass over the text runs at once)."""
    plist = _paths(paths)
    if names is None:
        names = header_names(spark, plist, sep, encoding, multi_line)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    records = read_records(spark, plist, sep, encoding, scan_path()) if multi_line else None
    if records is not None:
        df = parse_records(records, schema.add(CORRUPT_COL, T.StringType()) if corrupt else schema, sep, CORRUPT_COL if corrupt else None)
        corrupts = [CORRUPT_COL] if corrupt else []
        return df.select(*[F.col(f"`{n}`") for n in names], *corrupts, *(FILE_ORDER if file_order else ()))
    reader = _reader(spark, sep, encoding, False, header=True)
    if corrupt:
        schema = schema.add(CORRUPT_COL, T.StringType(), True)
        # a record is only held against its header if all its cells are parsed
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL).option("columnPruning", False)
    df = reader.schema(schema).csv(plist)
    if file_order:
        df = df.select(
            "*",
            scan_path().alias(FILE_COL),
            F.col("_metadata.file_block_start").alias(BLOCK_COL),
            F.monotonically_increasing_id().alias(ROW_COL),
        )
    return df


def file_facts(spark: SparkSession, paths, fallback: str = "ISO-8859-1") -> DataFrame:
    """``(path, header, encoding, quotes)`` of every file from one text scan:
    the first line (least position in the file's first split), the O-02
    encoding test and whether there is a quote, so grouping by header and
    choosing encodings cost one read of the bytes, not two."""
    lines = spark.read.text(_paths(paths)).select(
        scan_path().alias("path"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_r"),
        "value",
    )
    first = F.col("_b") == 0
    # min_by skips rows whose ordering is null: only first-split lines count.
    facts = lines.groupBy("path").agg(
        F.min_by(F.when(first, F.col("value")), F.when(first, F.col("_r"))).alias("header"),
        F.when(F.bool_and(F.is_valid_utf8("value")), F.lit("UTF-8")).otherwise(F.lit(fallback)).alias("encoding"),
        F.bool_or(F.contains("value", F.lit('"'))).alias("quotes"),
    )
    return facts.select("path", F.regexp_replace("header", "\r$", "").alias("header"), "encoding", "quotes")


def file_headers(spark: SparkSession, paths) -> DataFrame:
    """``(path, header)``: the first line of every file (see ``file_facts``)."""
    return file_facts(spark, paths).select("path", "header")


def header_groups(spark: SparkSession, paths, with_encodings: bool = False):
    """Paths grouped by identical header line (one row per file is read to
    the driver: bounded by the file count). ``with_encodings`` also returns
    ``{path: encoding}`` from the same scan."""
    groups: dict[str, list[str]] = {}
    enc: dict[str, str] = {}
    for r in file_facts(spark, paths).orderBy("path").collect():
        groups.setdefault(r["header"], []).append(r["path"])
        enc[r["path"]] = r["encoding"]
    out = [ps for _, ps in sorted(groups.items(), key=lambda kv: kv[1][0])]
    return (out, enc) if with_encodings else out


class Layout(NamedTuple):
    """How a file is read: its column names and its encoding."""

    names: tuple[str, ...]
    encoding: str
    quotes: bool = True  # without a quote, every line is a record


def file_layouts(spark: SparkSession, paths, sep: str = ",", encoding: str | None = None, multi_line: bool = False) -> dict[str, Layout]:
    """The layout of every file: one text pass over all of them and, per
    different header, one small read. A header that goes on beyond its first
    line (a quoted line break) is read for its file alone. Files without any
    line have no layout."""
    groups: dict[tuple, list[str]] = {}
    for r in file_facts(spark, paths).orderBy("path").collect():
        if r["header"] is None:
            continue
        open_quote = multi_line and r["header"].count('"') % 2
        groups.setdefault((r["path"] if open_quote else "", r["header"], encoding or r["encoding"]), []).append(r)
    out = {}
    for (_, _, enc), rs in groups.items():
        names = tuple(header_names(spark, [rs[0]["path"]], sep, enc, multi_line))
        out |= {r["path"]: Layout(names, enc, r["quotes"]) for r in rs}
    return out


def read_by_header(
    spark: SparkSession,
    paths,
    sep: str = ",",
    multi_line: bool = False,
    file_order: bool = False,
    encoding: str | None = None,
    layouts: dict[str, Layout] | None = None,
    ragged: bool = False,
) -> DataFrame:
    """O-01 over files of unlike headers: files of one layout are one scan,
    read by that header, and the scans meet by column name; a column that a
    file lacks is missing there. Columns come in the order in which the files,
    by path, bring them. ``ragged`` adds ``_ragged``. ``layouts`` (of
    ``file_layouts``) saves the pass that finds them."""
    if layouts is None:
        layouts = file_layouts(spark, paths, sep, encoding, multi_line)
        known = sorted(layouts)
    else:
        known = [p for p in _paths(paths) if p in layouts]
    if not known:
        raise ValueError("no input file has a header")
    groups: dict[Layout, list[str]] = {}
    for p in known:
        groups.setdefault(layouts[p], []).append(p)
    frames, columns = [], {}
    for layout, ps in groups.items():
        df = read_delimited(spark, ps, sep, layout.encoding, multi_line and layout.quotes, layout.names, file_order, corrupt=ragged)
        if ragged:
            # Spark reads a corrupt record's text only along with a data column
            parsed = F.length(F.concat_ws("", F.col(f"`{layout.names[0]}`"))) >= 0
            df = df.withColumn(RAGGED_COL, parsed & is_ragged(len(layout.names), sep)).drop(CORRUPT_COL)
        columns |= dict.fromkeys(layout.names)
        frames.append(df)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return whole.select(*[F.col(f"`{c}`") for c in columns], *[c for c in (*FILE_ORDER, RAGGED_COL) if c in whole.columns])


def choose_encoding(spark: SparkSession, paths, fallback: str = "ISO-8859-1") -> DataFrame:
    """O-02: ``(path, encoding)``: UTF-8 when every line is valid UTF-8,
    else the fallback. One grouped pass over the raw lines of all files."""
    lines = spark.read.text(_paths(paths)).select(scan_path().alias("path"), F.is_valid_utf8("value").alias("ok"))
    return lines.groupBy("path").agg(F.when(F.bool_and("ok"), F.lit("UTF-8")).otherwise(F.lit(fallback)).alias("encoding"))


def read_with_encodings(
    spark: SparkSession,
    paths,
    sep: str = ",",
    multi_line: bool = False,
    file_order: bool = False,
    encoding: str | None = None,
    encodings: dict[str, str] | None = None,
    corrupt: bool = False,
) -> DataFrame:
    """O-01 + O-02: one scan per encoding group, unioned. The list of paths
    per encoding is one row per file (bounded by the file count).

    Detection reads every byte once more as text; pass ``encoding`` when the
    folder's encoding is known, or ``encodings`` (``{path: encoding}``, e.g.
    from ``header_groups``) when it was already detected, to skip that pass."""
    if encoding:
        return read_delimited(spark, paths, sep, encoding, multi_line, None, file_order, corrupt)
    known = encodings or {}
    pairs = [(p, known[p]) for p in _paths(paths) if p in known]
    rest = [p for p in _paths(paths) if p not in known]
    if rest:
        pairs += [(r["path"], r["encoding"]) for r in choose_encoding(spark, rest).collect()]
    groups: dict[str, list[str]] = {}
    for p, e in pairs:
        groups.setdefault(e, []).append(p)
    if not groups:
        raise ValueError("no input files")
    first_enc, first_paths = sorted(groups.items())[0]
    names = header_names(spark, first_paths, sep, first_enc, multi_line)
    dfs = [read_delimited(spark, ps, sep, e, multi_line, names, file_order, corrupt) for e, ps in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b), dfs)


def read_metadata(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """O-04: the sidecar (full or minimal form); unnamed trailing columns
    (from trailing commas) are dropped; ``column_index`` is the line order."""
    df = read_delimited(spark, path, sep, file_order=True)
    keep = [c for c in df.columns if not c.startswith("Unnamed: ") and c not in FILE_ORDER]
    df = df.select(*keep, F.col(BLOCK_COL), F.col(ROW_COL))
    # A sidecar is small (one line per column): number its lines in one task.
    from pyspark.sql import Window

    w = Window.orderBy(BLOCK_COL, ROW_COL)
    return df.withColumn("column_index", F.row_number().over(w) - 1).drop(BLOCK_COL, ROW_COL)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """O-05: the first rows, of a scan with its file order the first in that
    order (a limit is the feature here)."""
    if set(FILE_ORDER) <= set(df.columns):
        df = df.orderBy(*FILE_ORDER)
    return df.limit(n)


def dtypes(df: DataFrame) -> DataFrame:
    """O-05: ``(column_name, dtype)`` of a DataFrame, as a DataFrame."""
    spark = df.sparkSession
    return spark.createDataFrame(list(df.dtypes), "column_name string, dtype string")
