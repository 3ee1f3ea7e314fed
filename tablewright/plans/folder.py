"""Folder-level flows: profile a folder (O-35), add a key to a file
(entry 3), and load a folder into keyed tables (O-65).

The driver walks the *catalogue* (one entry per table); every table is one
multi-path scan and every step on rows is a Spark job. Row data never passes
through the driver.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import base_name, table_name_of
from ..functions.patterns import KEY_FLAG_NAMES, NA_TOKENS, SPLIT_SUFFIX_PATTERN, all_type_tags
from ..operators import items, ordinal, profile, split
from ..options import LoadOptions
from ..sinks import ledger as led
from ..sinks import tables
from ..sources import catalog as cat
from ..sources.delimited import CORRUPT_COL, FILE_COL, FILE_ORDER, RAGGED_COL, Layout, choose_encoding, file_layouts, is_ragged, read_by_header, read_delimited, read_metadata


def _table_files(catalog: DataFrame) -> dict[str, list[str]]:
    """table -> data file paths (one row per file: bounded by the listing)."""
    out: dict[str, list[str]] = {}
    for r in cat.data_files(catalog).select("table_name", "path").orderBy("table_name", "path").collect():
        out.setdefault(r["table_name"], []).append(r["path"])
    return out


def _in_threads(run, units, threads: int = 4) -> list:
    """Submit independent Spark jobs from a few threads."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(run, units))


def _sidecars(catalog: DataFrame) -> dict[str, str]:
    return {r["data_name"]: r["path"] for r in cat.metadata_files(catalog).select("data_name", "path").collect()}


def profile_folder(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    with_key_flags: bool = True,
    per_file: bool = True,
    encoding: str | None = None,
    multi_line: bool = False,
    na_tokens=NA_TOKENS,
) -> DataFrame:
    """O-35: the profile of every data file in a folder (``_file`` column),
    plus its key flags; files of one header are one grouped job, all unioned
    into one result. ``per_file=False`` profiles each table as a whole: its
    parts, each read by its own header, by column name and in file order."""
    catalog = cat.data_files(cat.file_catalog(spark, path))
    paths_of = _table_files(catalog)
    # One text pass finds every file's header and encoding.
    layouts = file_layouts(spark, [p for ps in paths_of.values() for p in ps], sep, encoding, multi_line) if paths_of else {}
    if per_file:
        by_names: dict[tuple, list[str]] = {}
        for p in sorted(layouts):
            by_names.setdefault(layouts[p].names, []).append(p)
        units = [(None, ps) for ps in by_names.values()]
    else:
        units = [(t, [p for p in ps if p in layouts]) for t, ps in paths_of.items()]

    def unit_profile(unit) -> DataFrame:
        table, paths = unit
        df = read_by_header(spark, paths, sep, multi_line, file_order=True, layouts=layouts)
        cols = [c for c in df.columns if c not in FILE_ORDER]
        if per_file:
            by, order = [FILE_COL], [F.col("_block"), F.col("_row")]
        else:
            by, order = [], [F.col(c) for c in FILE_ORDER]
        prof = profile.profile(df, order=order, by=by, columns=cols, na_tokens=na_tokens, n_groups=len(paths))
        if table is None:
            prof = prof.withColumn("table_name", table_name_of(base_name(F.col(FILE_COL))))
        else:
            prof = prof.withColumn("table_name", F.lit(table))
        if with_key_flags:
            # The key tests are the profile's own flags of column 0 (strict
            # rule), so no second pass over the data is needed.
            # A window over the profile rows (one per column and file) carries
            # column 0's warnings to every row of its file or table.
            warn = F.concat_ws(
                ",",
                F.when(F.col("mixed_datatype_flag_list"), F.lit("mixed_datatype_flag")),
                F.when(F.col("missing_data_flag_list"), F.lit("missing_data_flag")),
                F.when(F.col("duplicate_data_flag_list"), F.lit("duplicate_data_flag")),
            )
            w = Window.partitionBy(*by, "table_name")
            prof = prof.withColumn("key_warnings", F.max(F.when(F.col("column_index") == 0, warn)).over(w))
        return prof

    outs = _in_threads(unit_profile, [u for u in units if u[1]])
    if not outs:
        raise ValueError(f"no data files under {path}")
    return reduce(lambda a, b: a.unionByName(b), outs)


def detect_encodings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """O-02 for a whole folder in one text pass (one row per file)."""
    return {r["path"]: r["encoding"] for r in choose_encoding(spark, paths).collect()}


def write_profiles(
    spark: SparkSession, path: str, out_dir: str, sep: str = ",", encoding: str | None = None, multi_line: bool = False, na_tokens=NA_TOKENS
) -> list[str]:
    """Entry 2 (profile only): a sidecar file ``metadata_<name>`` in
    ``out_dir`` for every data file that has none."""
    catalog = cat.file_catalog(spark, path)
    todo = cat.files_without_metadata(catalog).select("path", "name").orderBy("path").collect()
    layouts = file_layouts(spark, [r["path"] for r in todo], sep, encoding, multi_line) if todo else {}

    def write(r) -> str | None:
        target = f"{out_dir.rstrip('/')}/metadata_{r['name']}"
        if r["path"] not in layouts or tables.path_exists(spark, target):
            return None
        df = read_by_header(spark, [r["path"]], sep, multi_line, file_order=True, layouts=layouts)
        cols = [c for c in df.columns if c not in FILE_ORDER]
        meta = profile.profile(df, order=[F.col("_block"), F.col("_row")], columns=cols, na_tokens=na_tokens)
        tables.write_metadata(meta, target)
        return target

    return [t for t in _in_threads(write, todo) if t]


def add_key_to_file(
    spark: SparkSession, src: str, dst: str, name: str = "Row_Number", prefix: str | None = None, sep: str = ",",
    encoding: str | None = None, multi_line: bool = False,
) -> None:
    """Entry 3: number the rows of a file in file order and write it (with the
    key first) to a new path."""
    df = read_by_header(spark, src, sep, multi_line, file_order=True, encoding=encoding)
    cols = [c for c in df.columns if c not in FILE_ORDER]
    if prefix is None:
        keyed = ordinal.add_row_key(df, order=FILE_ORDER, name=name)
    else:
        keyed = ordinal.add_prefixed_key(df, prefix, order=FILE_ORDER, name=name)
    tables.write_keyed(keyed.select(name, *cols), dst)


LEDGER_ROW = "path string, table_name string, n_rows bigint, status string, message string"


def _log(spark: SparkSession, opts: LoadOptions, rows: list[tuple]) -> None:
    if rows:
        led.append_ledger(spark, opts.ledger, spark.createDataFrame(rows, LEDGER_ROW))


def _sidecar_of(path: str, sidecars: dict[str, str]) -> str | None:
    """A file's own sidecar, else the one of the whole table."""
    name = path.rsplit("/", 1)[-1]
    return sidecars.get(name) or sidecars.get(re.sub(SPLIT_SUFFIX_PATTERN, "", name) + ".csv")


class FileGroup(NamedTuple):
    """Files read alike: rows with ``_corrupt`` and the file order, the data
    columns, and the sidecar's rows (None: types from the data)."""

    frame: DataFrame
    columns: list[str]
    meta: list[tuple] | None


class Gated(NamedTuple):
    """What the gate lets through: typed rows (None: of no file), the key,
    rows per file, and why the others failed."""

    frame: DataFrame | None
    key: str
    counts: dict[str, int]
    failed: dict[str, str]


def file_groups(spark: SparkSession, opts: LoadOptions, paths: list[str], layouts: dict[str, Layout], sidecar: Callable[[str], str | None]) -> list[FileGroup]:
    """``paths`` in groups of one layout and one sidecar."""
    groups: dict[tuple, list[str]] = {}
    for p in paths:
        groups.setdefault((sidecar(p) or "", layouts[p]), []).append(p)
    out = []
    for (side, layout), ps in groups.items():
        df = read_delimited(spark, ps, opts.sep, layout.encoding, opts.multi_line and layout.quotes, layout.names, file_order=True, corrupt=True)
        meta = items.sidecar_rows(read_metadata(spark, side, opts.sep)) if side else None
        out.append(FileGroup(df, list(layout.names), meta))
    return out


def gate(spark: SparkSession, groups: list[FileGroup], opts: LoadOptions, key: str | None = None) -> Gated:
    """The checks of a load, in one scan. ``key`` is the key of the table
    where it exists, else the first column; a file without it misses it. An aggregate by file and key value
    yields each file's rows, key tests, records longer than the header and
    cells that are not what the sidecar says; what the data says of the types
    that are open is observed beside it. A faulty file fails as a whole, with
    the count."""
    key = key or next(g.meta[0][0] if g.meta else g.columns[0] for g in groups)
    scans, observed = [], []
    for df, cols, meta in groups:
        rows = [(c, None, None) for c in cols] if meta is None else [tuple(r) + (None,) * (3 - len(r)) for r in meta]
        open_ = [c for c, r in zip(cols, rows) if meta is None or (r[1] == "N" and not r[2])]
        bad = F.lit(0) if meta is None else items.misfits(df.select(*[F.col(f"`{c}`") for c in cols]), rows, opts.na_tokens)
        # Spark reads a corrupt record's text only along with a data column
        parsed = F.length(F.concat_ws("", F.col(f"`{cols[0]}`"))) >= 0
        source = next((F.col(f"`{c}`") for c, r in zip(cols, rows) if r[0] == key), F.lit(None).cast("string"))
        facts, aggs = profile.type_evidence(df, open_, opts.na_tokens)
        seen = Observation(f"types {uuid.uuid4().hex}")
        scan = facts.observe(seen, *aggs) if open_ else facts
        scans.append(scan.select(FILE_COL, source.alias("_key"), (parsed & is_ragged(len(cols), opts.sep)).cast("int").alias("ragged"), bad.alias("misfit")))
        observed.append((rows, open_, seen))
    whole = reduce(DataFrame.unionByName, scans)
    stats = profile.column_stats(whole, ["_key"], None, [FILE_COL], opts.na_tokens, with_example=False, plan="one_scan", sums=("ragged", "misfit")).collect()
    if not stats:  # headers alone: nothing was observed
        observed = [(rows, open_, None) for rows, open_, _ in observed]
    types, inexact = _open_types(groups, observed)
    misfit = {r[FILE_COL]: r["misfit"] for r in stats}
    for (df, _, _), cols in zip(groups, inexact):
        if cols:  # seldom: only then are these cells counted by file
            for r in df.groupBy(FILE_COL).agg(F.sum(items.inexact_cells(cols, opts.na_tokens)).alias("n")).collect():
                misfit[r[FILE_COL]] += r["n"]
    failed, counts = {}, {}
    for r in stats:
        counts[r[FILE_COL]] = r["n_rows"]
        warned = [n for n, v in zip(KEY_FLAG_NAMES, (r["mixed_datatype_flag_list"] and opts.strict_key, r["missing_data_flag_list"], r["duplicate_data_flag_list"])) if v]
        if warned:
            failed[r[FILE_COL]] = f"key column {key!r}: {warned}"
        elif r["ragged"] or misfit[r[FILE_COL]]:
            failed[r[FILE_COL]] = f"{r['ragged']} rows longer than the header, {misfit[r[FILE_COL]]} cells that do not fit their type"
    frame = _meet([items.apply_metadata(g.frame.drop(CORRUPT_COL), rows, opts.na_tokens, keep=FILE_ORDER) for g, rows in zip(groups, types)])
    if failed:
        out = spark.createDataFrame([(p,) for p in failed], f"{FILE_COL} string")
        frame = frame.join(F.broadcast(out), FILE_COL, "left_anti").select(frame.columns)  # a row per failed file
    return Gated(frame, key, counts, failed)


def _open_types(groups: list[FileGroup], observed) -> tuple[list[list[tuple]], list[list[str]]]:
    """Per group: its sidecar rows with every type decided, and the columns
    of doubles that hold whole numbers which a double would round. Files
    without a sidecar decide a column's type together."""
    kinds = ("missing", "present", "inexact", "int", "i64", "u64", "float", "bool")
    evidence, rows_seen = [], []
    for _, open_, seen in observed:
        found = seen.get if open_ and seen is not None else {}
        evidence.append({c: {k: found.get(f"{k}_{i}", False) for k in kinds} for i, c in enumerate(open_)})
        rows_seen.append(found.get("rows", not open_))
    bare = [i for i, g in enumerate(groups) if g.meta is None]
    shared: dict[str, str] = {}
    for c in dict.fromkeys(c for i in bare for c in groups[i].columns):
        held = [evidence[i][c] for i in bare if c in evidence[i] and rows_seen[i]]
        whole = {k: (any if k in ("missing", "present", "inexact") else all)(e[k] for e in held) for k in kinds}
        # a file without the column misses all its cells
        whole["missing"] = whole["missing"] or any(rows_seen[i] and c not in evidence[i] for i in bare)
        shared[c] = profile.dtype_of_evidence(any(rows_seen[i] for i in bare), whole)
    types, inexact = [], []
    for i, (rows, open_, _) in enumerate(observed):
        if groups[i].meta is None:
            out = [(c, all_type_tags()[shared[c]], shared[c]) for c in groups[i].columns]
            doubles = [c for c in open_ if shared[c] == "float64"]
        else:
            numbers = {c: t if (t := profile.dtype_of_evidence(rows_seen[i], evidence[i][c])) in ("int64", "uint64", "float64") else "float64" for c in open_}
            out = [(n, tag, numbers.get(c, dtype)) for c, (n, tag, dtype) in zip(groups[i].columns, rows)]
            doubles = [c for c in open_ if numbers[c] == "float64"]
        types.append(out)
        inexact.append([c for c in doubles if evidence[i][c]["inexact"]])
    return types, inexact


def _load_table(spark: SparkSession, opts: LoadOptions, table: str, todo: list[str], layouts: dict[str, Layout], sidecar: Callable[[str], str | None], lengths: dict[str, int]) -> None:
    """One table of O-65. Files are read in groups of one header and one
    sidecar, each with its own names; groups meet by column name. Files that
    the gate refuses are logged with the reason; the others are put."""
    try:
        _log(spark, opts, [(p, table, None, "failed", "the file has no header") for p in todo if p not in layouts])
        todo = [p for p in todo if p in layouts]
        if not todo:
            return
        target = f"{opts.output_path.rstrip('/')}/{table}"
        frame, key, counts, failed = gate(spark, file_groups(spark, opts, todo, layouts, sidecar), opts, tables.key_of(spark, target))
        _log(spark, opts, [(p, table, None, "failed", why) for p, why in failed.items()])
        good = [p for p in todo if p not in failed]
        if not good:
            return
        order = [F.col(c) for c in FILE_ORDER]
        status, note = "done", None
        n_bytes, n_all = sum(lengths[p] for p in good), sum(counts.get(p, 0) for p in good)
        if opts.row_range is not None:
            frame = ordinal.row_range(frame, FILE_ORDER, *opts.row_range, ordinal_name="_pos")
            order, status, note = [F.col("_pos")], "partial", "rows [{}, {})".format(*opts.row_range)
            counts = {r[FILE_COL]: r["count"] for r in frame.groupBy(FILE_COL).count().collect()}
        schema = T.StructType([f for f in frame.schema.fields if f.name not in tables.ENGINE_COLS])
        tables.create_table(spark, schema, target, key)
        n_rows = sum(counts.get(p, 0) for p in good)
        if n_rows:
            tables.upsert_table(spark, target, frame, key, order=order, expected_rows=n_rows, expected_bytes=n_bytes * n_rows // n_all)
        # a file with a header alone has no row in the counts
        _log(spark, opts, [(p, table, counts.get(p, 0), status, note) for p in good])
    except Exception as e:  # the reference reports the table and moves on
        _log(spark, opts, [(p, table, None, "failed", str(e)) for p in todo])


def _meet(frames: list[DataFrame]) -> DataFrame:
    """Typed groups of one table, by column name, each column in the type
    that holds all its values."""
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            types[f.name] = tables.common_type(types[f.name], f.dataType, f.name) if f.name in types else f.dataType
    widened = [df.select(*[tables.lossless(f.name, f.dataType, types[f.name]).alias(f.name) for f in df.schema.fields]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), widened)


def load_folder(spark: SparkSession, opts: LoadOptions, parallel_tables: int = 4) -> DataFrame:
    """O-65: what is left to load, key gate, names, sidecars, create, upsert,
    ledger, report. With ``split`` every source file that is not yet split is
    first written in parts of at most ``max_rows_per_part`` rows
    (``split_sources``), and the parts are loaded; ``profile_only`` writes
    sidecars and loads nothing.

    Returns the run report (O-72) over the folder's catalogue."""
    if opts.profile_only or opts.make_sidecars:
        write_profiles(spark, opts.input_path, opts.input_path, opts.sep, opts.encoding, opts.multi_line, opts.na_tokens)
    sources = cat.file_catalog(spark, opts.input_path)
    sidecars = _sidecars(sources)
    bad = [r["table_name"] for r in cat.invalid_table_names(sources).collect()]
    if bad:
        raise ValueError(f"invalid table names: {bad}")
    by_parts = opts.split and not opts.profile_only
    catalog = sources
    if by_parts:
        split_sources(spark, opts, cat.data_files(sources), sidecars)
        catalog = published_parts(spark, opts)
    ledger = led.read_ledger(spark, opts.ledger)
    left = cat.remaining_files(catalog, ledger)
    if opts.profile_only:
        _log(spark, opts, [(r["path"], r["table_name"], None, "profiled", None) for r in left.collect()])
    else:
        append = opts.append or opts.row_range is not None or not left.filter(F.col("part").isNotNull()).isEmpty()
        # a table that this ledger has rows of was begun by an earlier run of this load
        begun = ledger.where("status IN ('done', 'partial')").select("table_name").distinct()
        existing = tables.existing_tables(spark, opts.output_path).join(begun, "table_name", "left_anti")
        clash = [] if append else [r["table_name"] for r in cat.name_collisions(left, existing).collect()]
        if clash:
            raise ValueError(f"tables already exist: {clash}")
        work = list(_table_files(left).items())
        if by_parts:  # the part list has the layouts and sidecars
            listed = {r["path"]: r for r in left.select("path", "names", "encoding", "sidecar").collect()}
            layouts = {p: Layout(tuple(r["names"]), r["encoding"]) for p, r in listed.items()}
            sidecar = lambda p: listed[p]["sidecar"]
        else:
            layouts = file_layouts(spark, [p for _, ps in work for p in ps], opts.sep, opts.encoding, opts.multi_line) if work else {}
            sidecar = lambda p: _sidecar_of(p, sidecars)
        lengths = {r["path"]: r["length"] for r in left.select("path", "length").collect()}  # as many rows as files
        # Tables are independent: their jobs are submitted from a few threads so
        # small tables do not leave the cluster idle.
        _in_threads(lambda tw: _load_table(spark, opts, tw[0], tw[1], layouts, sidecar, lengths), work, parallel_tables)
    listing_rows = cat.data_files(catalog).select("path", "table_name", "is_metadata")
    ledger = led.read_ledger(spark, opts.ledger)
    if by_parts:  # sources of which no parts are published are to go, or failed
        unsplit = cat.data_files(sources).join(ledger.where("status = 'split'").select("path"), "path", "left_anti")
        listing_rows = listing_rows.unionByName(unsplit.select("path", "table_name", "is_metadata"))
    counts = ledger.groupBy("path").agg(F.max("n_rows").alias("n_rows"))
    return led.run_report(listing_rows.join(counts, on="path", how="left"), ledger)


def _split_folder(opts: LoadOptions) -> str:
    return f"{opts.output_path.rstrip('/')}/_split"


def split_sources(spark: SparkSession, opts: LoadOptions, sources: DataFrame, sidecars: dict[str, str]) -> None:
    """O-44 for a folder, restartable: every source file that the ledger does
    not call ``split`` is written in parts of at most ``max_rows_per_part``
    rows, each file cut by itself, in file order and under its own header.

    Per table the parts and their list are written to folders of this run;
    the ledger's rows, written last, publish them. A run that stops before
    leaves files that nothing refers to, and the next run splits the sources
    again. A file with records longer than its header fails as a whole."""
    ledger = led.read_ledger(spark, opts.ledger)
    done = ledger.where("status = 'split'")
    parts_before = {r["table_name"]: r["n"] for r in _parts_of(spark, opts, ledger).groupBy("table_name").agg(F.max("part").alias("n")).collect()}
    work = list(_table_files(sources.join(done.select("path"), "path", "left_anti")).items())
    runs = done.select("message").distinct().count()  # later runs' parts sort behind earlier ones'
    layouts = file_layouts(spark, [p for _, ps in work for p in ps], opts.sep, opts.encoding, opts.multi_line) if work else {}

    def run(unit) -> None:
        table, paths = unit
        try:
            _log(spark, opts, _split_table(spark, opts, table, paths, layouts, sidecars, f"{runs:08d}-{uuid.uuid4().hex}", parts_before.get(table) or 0))
        except Exception as e:
            _log(spark, opts, [(p, table, None, "failed", str(e)) for p in paths])

    _in_threads(run, work)


def _split_table(spark, opts: LoadOptions, table: str, paths: list[str], layouts, sidecars, attempt: str, parts_before: int) -> list[tuple]:
    """Parts of one table's files; returns the ledger rows that publish them."""
    rows = [(p, table, None, "failed", "the file has no header") for p in paths if p not in layouts]
    groups: dict[tuple, list[str]] = {}
    for p in paths:
        if p in layouts:
            groups.setdefault((layouts[p], _sidecar_of(p, sidecars)), []).append(p)
    scans = {g: read_by_header(spark, ps, opts.sep, opts.multi_line, file_order=True, layouts=layouts, ragged=True) for g, ps in groups.items()}
    counted = [ordinal.file_splits(df, F.sum(F.col(RAGGED_COL).cast("int")).alias("_ragged_rows")) for df in scans.values()]
    if not counted:
        return rows
    # One row per file and split: rows, and per file the number of its first part.
    splits = ordinal.stored(reduce(DataFrame.unionByName, counted), "split-counts")
    files = splits.groupBy(FILE_COL).agg(F.max("_file_rows").alias("n"), F.sum("_ragged_rows").alias("ragged"))
    files = files.withColumn("k", F.when(F.col("ragged") == 0, split.split_plan_col("n", opts.max_rows_per_part)))
    before = Window.orderBy(FILE_COL).rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = ordinal.stored(files.withColumn("first", F.lit(parts_before) + F.coalesce(F.sum(F.pow(F.lit(2.0), "k").cast("bigint")).over(before), F.lit(0))), "split-files")
    facts = {r[FILE_COL]: r for r in files.collect()}
    cuts = splits.join(files.where("ragged = 0").drop("ragged"), FILE_COL)
    listed, folder = [], f"{_split_folder(opts)}/{attempt}"
    for i, ((layout, sidecar), ps) in enumerate(groups.items()):
        bad = [p for p in ps if p in facts and facts[p]["ragged"]]
        rows += [(p, table, None, "failed", f"{facts[p]['ragged']} rows longer than the header") for p in bad]
        rows += [(p, table, facts[p]["n"] if p in facts else 0, "split", attempt) for p in ps if p not in bad]
        empty = [p for p in ps if p not in facts]  # a header alone: listed as it is
        if empty:
            listed.append(spark.createDataFrame([(p, p.rsplit("/", 1)[-1], table, 0, list(layout.names), layout.encoding, sidecar, 0) for p in empty], split.PART_LIST_SCHEMA))
        if len(bad) + len(empty) < len(ps):
            scan = scans[layout, sidecar]
            placed = ordinal.join_splits(scan.where(~F.col(FILE_COL).isin(bad)) if bad else scan, cuts, "_in_file", "_pos")
            parts = placed.withColumn("part", F.col("first") + split.part_of("_pos", F.col("n"), F.col("k")))
            # one shuffle, by part: a part is one file of bounded size
            split.write_part_files(parts.select(*[F.col(f"`{c}`") for c in layout.names], "part", "_pos").repartition("part"), folder, opts.sep, i)
            listed.append(split.list_parts(spark, folder, table, layout.names, sidecar, i))
    if listed:
        reduce(DataFrame.unionByName, listed).write.parquet(f"{_split_folder(opts)}/{split.PART_LIST}/attempt={attempt}")
    return rows


def _parts_of(spark: SparkSession, opts: LoadOptions, ledger: DataFrame) -> DataFrame:
    """The part list of what the ledger has published."""
    attempts = [r[0] for r in ledger.where("status = 'split'").select("message").distinct().collect()]
    if not attempts:
        return spark.createDataFrame([], split.PART_LIST_SCHEMA)
    return split.part_list(spark, _split_folder(opts), attempts)


def published_parts(spark: SparkSession, opts: LoadOptions) -> DataFrame:
    """The catalogue of the published parts."""
    return cat.catalog_of_parts(_parts_of(spark, opts, led.read_ledger(spark, opts.ledger)))


def split_folder(spark: SparkSession, path: str, out_dir: str, max_rows: int, sep: str = ",", encoding: str | None = None, multi_line: bool = False) -> DataFrame:
    """O-44 for a folder: every table of ``path`` written in ``out_dir`` as
    part files of at most ``max_rows`` rows, in file order, that load as one
    table. Returns the part list."""
    layouts = file_layouts(spark, path, sep, encoding, multi_line)

    def write(table_paths) -> None:
        table, paths = table_paths
        df = read_by_header(spark, paths, sep, multi_line, file_order=True, layouts=layouts)
        split.write_parts(df, out_dir, max_rows, order=FILE_ORDER, drop=FILE_ORDER, table=table, sep=sep)

    _in_threads(write, _table_files(cat.file_catalog(spark, path)).items())
    return split.part_list(spark, out_dir)
