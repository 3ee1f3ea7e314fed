"""Table sinks: O-60, O-61 (storage side), O-62, O-63, O-64.

A keyed table is a folder of parquet buckets by key hash plus numbered
manifests. A put writes new copies of the buckets it touches beside the old
ones, one file each, and publishes them by renaming one manifest into place:
readers see the version before or the version after, and a put that stops
part-way has changed nothing. The number of buckets doubles as the table
grows. Superseded buckets go when the next version but one is published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import EXACT_DOUBLE_INT, META_COLUMNS
from ..operators.items import sidecar_rows
from ..operators.upsert import upsert

#: Columns that the engine itself adds to a batch.
ENGINE_COLS = frozenset(("_file", "_block", "_row", "_pos", "_bucket"))


def spark_type(tag: str, dtype: str | None = None) -> T.DataType:
    """Storage type of a sidecar column."""
    if tag == "N":
        if dtype == "int64":
            return T.LongType()
        if dtype == "uint64":
            return T.DecimalType(20, 0)
        return T.DoubleType()
    if tag == "BOOL":
        return T.BooleanType()
    if tag in ("SS", "L"):
        return T.ArrayType(T.StringType())
    if tag == "NS":
        return T.ArrayType(T.DoubleType())
    if tag == "BS":
        return T.ArrayType(T.BinaryType())
    if tag == "M":
        return T.MapType(T.StringType(), T.StringType())
    return T.StringType()


def schema_from_sidecar(meta) -> T.StructType:
    rows = sidecar_rows(meta) if isinstance(meta, DataFrame) else [tuple(r) + (None,) * (3 - len(r)) for r in meta]
    return T.StructType([T.StructField(n, spark_type(t, d), True) for n, t, d in rows])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of sub-folders (the tables under a warehouse folder)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def create_table(spark: SparkSession, meta, path: str, key: str | None = None) -> T.StructType:
    """O-60: create an empty keyed table with its sidecar's schema; the key
    is ``key`` or the first column. An existing table is left as it is.
    Returns the table's schema."""
    held = _manifest(spark, path)
    if held is not None:
        return T.StructType.fromJson(held["schema"])
    schema = schema_from_sidecar(meta) if not isinstance(meta, T.StructType) else meta
    _publish(spark, path, None, {"buckets": 1, "key": [key or schema.names[0]], "schema": schema.jsonValue(), "folders": {}, "rows": {}})
    return schema


def key_of(spark: SparkSession, path: str) -> str | None:
    """The key column of a keyed table; None where there is no table."""
    held = _manifest(spark, path)
    return held["key"][0] if held else None


def existing_tables(spark: SparkSession, warehouse: str) -> DataFrame:
    """Tables present under a warehouse folder, as ``(table_name)``."""
    return spark.createDataFrame([(n,) for n in list_dirs(spark, warehouse)], "table_name string")


def load_new(df: DataFrame, path: str) -> None:
    """O-62: write a new table; fails when it exists."""
    df.write.mode("errorifexists").parquet(path)


def write_metadata(meta: DataFrame, path: str) -> None:
    """O-63: the sidecar as one CSV file at ``path`` with header (one line per
    column, so a single task is bounded by the column count)."""
    cols = [c for c in META_COLUMNS if c in meta.columns]
    order = ["column_index"] if "column_index" in meta.columns else []
    out = meta.orderBy(*order).select(*cols) if order else meta.select(*cols)
    if path_exists(spark := meta.sparkSession, path):
        raise FileExistsError(f"{path} exists")
    folder, name = path.rstrip("/").rsplit("/", 1)
    staging = f"{folder}/_staging_{name}_{uuid.uuid4().hex[:8]}"
    out.coalesce(1).write.option("header", True).option("escape", '"').csv(staging)
    fs, sp = _fs(spark, staging)
    part = next(st.getPath() for st in fs.listStatus(sp) if st.getPath().getName().endswith(".csv"))
    if not fs.rename(part, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"could not write {path}")
    fs.delete(sp, True)


def write_keyed(df: DataFrame, path: str) -> None:
    """O-64: the data with its new key column, as CSV under a new path."""
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


BUCKET_COL = "_bucket"
ROWS_PER_BUCKET = 2_000_000
#: Bytes of cells in a bucket, which one task writes.
BYTES_PER_BUCKET = 128 << 20
MANIFESTS = "_manifest"


def buckets_for(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET, n_bytes: int = 0) -> int:
    """Bucket count of a new table: about ``rows_per_bucket`` rows each, of
    about ``BYTES_PER_BUCKET`` in all."""
    return max(1, -(-int(n_rows) // rows_per_bucket), -(-int(n_bytes) // BYTES_PER_BUCKET))


def cell_bytes(df: DataFrame):
    """Aggregate: the size of all cells, texts and binaries by length,
    collections by their text, others by a width of 8."""

    def size(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0))
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        return F.lit(8)

    sizes = [size(f).cast("bigint") for f in df.schema.fields if f.name not in ENGINE_COLS]
    return F.coalesce(F.sum(sum(sizes, F.lit(0).cast("bigint"))), F.lit(0))


def bucket_of(keys: Sequence[str], n_buckets: int):
    """Hash bucket of a key; doubling ``n_buckets`` splits each in two."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n_buckets)).cast("int")


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def _manifest_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/v{version:010d}.json"


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The given or newest manifest, with its ``version``."""
    if version is None:
        held = _versions(spark, path)
        if not held:
            return None
        version = held[-1]
    fs, p = _fs(spark, _manifest_path(path, version))
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        text = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return json.loads(text) | {"version": version}


def _publish(spark: SparkSession, path: str, seen: int | None, manifest: dict) -> None:
    """Make ``manifest`` the version after ``seen`` (None: the first), by one
    rename; fails if another put has published that version."""
    version = 1 if seen is None else seen + 1
    target = _manifest_path(path, version)
    temp = f"{path.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}"
    fs, tp = _fs(spark, temp)
    out = fs.create(tp, False)
    try:
        out.write(bytearray(json.dumps({k: v for k, v in manifest.items() if k != "version"}).encode("utf-8")))
    finally:
        out.close()
    dst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(dst) or not fs.rename(tp, dst):
        fs.delete(tp, False)
        raise RuntimeError(f"another put published version {version} of {path}")


def _tidy(spark: SparkSession, path: str, version: int) -> None:
    """Drop what neither ``version`` nor the one before it refers to."""
    old = [v for v in _versions(spark, path) if v < version - 1]
    if not old:
        return
    kept = {f for v in (version - 1, version) for f in _manifest(spark, path, v)["folders"].values()}
    for v in old:
        gone = sorted(set(_manifest(spark, path, v)["folders"].values()) - kept)
        for place in [*(f"{path.rstrip('/')}/{folder}" for folder in gone), _manifest_path(path, v)]:
            fs, p = _fs(spark, place)
            fs.delete(p, True)


def _read_buckets(spark: SparkSession, path: str, schema: T.StructType, folders) -> DataFrame:
    places = [f"{path.rstrip('/')}/{f}" for f in folders]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version of a keyed table."""
    held = _manifest(spark, path)
    if held is None:
        raise ValueError(f"{path} is not a keyed table")
    return _read_buckets(spark, path, T.StructType.fromJson(held["schema"]), held["folders"].values())


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_type(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
    """The type that holds the values of both; an error if none does. Whole
    numbers go into a double column only where the double is exact."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    whole = [isinstance(t, _INTEGERS) or (isinstance(t, T.DecimalType) and t.scale == 0) for t in (a, b)]
    if all(isinstance(t, _INTEGERS) for t in (a, b)):
        return max((a, b), key=lambda t: _INTEGERS.index(type(t)))
    if all(whole):
        return T.DecimalType(max(t.precision if isinstance(t, T.DecimalType) else 20 for t in (a, b)), 0)
    if any(isinstance(t, (T.DoubleType, T.FloatType)) for t in (a, b)) and all(w or isinstance(t, (T.DoubleType, T.FloatType)) for w, t in zip(whole, (a, b))):
        return T.DoubleType()
    raise ValueError(f"column {name!r} holds {a.simpleString()} and is given {b.simpleString()}")


def lossless(name: str, held: T.DataType, wanted: T.DataType):
    """A column as a wider type; an inexact value stops the put."""
    c = F.col(f"`{name}`")
    if held == wanted:
        return c
    if isinstance(wanted, T.DoubleType) and not isinstance(held, T.FloatType):
        fits = c.isNull() | (F.abs(c.cast("decimal(38,0)")) <= F.lit(EXACT_DOUBLE_INT))
        c = F.when(fits, c).otherwise(F.raise_error(F.lit(f"a value of column {name!r} is not exact as a double")).cast(held))
    return c.cast(wanted)


def _as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(lossless(f.name, have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def _coming(batch: DataFrame, rows: int | None, size: int | None, rows_per_bucket: int) -> tuple[int, int, int]:
    """Rows of a batch, the rows of a bucket, and the batch's bytes; counted
    where they are not known."""
    if rows is None or size is None:
        found = batch.agg(F.count(F.lit(1)).alias("n"), cell_bytes(batch).alias("size")).first()
        rows, size = found["n"] if rows is None else rows, found["size"] if size is None else size
    return rows, rows_per_bucket, size


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str | Sequence[str],
    order=None,
    schema: T.StructType | None = None,
    n_buckets: int | None = None,
    expected_rows: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    expected_bytes: int | None = None,
) -> int:
    """O-61 on storage: put every batch row into the keyed table at ``path``
    (last row per key wins, whole-item replace).

    Only buckets the batch touches are read and written anew, one file each,
    so the cost follows the batch. Columns new to the table are added; a
    wider type widens the column (all buckets are then written anew); a type
    that does not fit fails the put before anything is published. A batch
    applied twice gives the same table. A new table gets ``n_buckets``
    (default: by ``expected_rows`` and ``expected_bytes``, or the batch);
    later the count doubles until a bucket holds about ``rows_per_bucket`` and
    ``BYTES_PER_BUCKET``, the batch included: rows may be whole texts, and a
    bucket is one task's. Returns the number of buckets written."""
    from ..operators.upsert import last_per_key, upsert

    keys = [key] if isinstance(key, str) else list(key)
    held = _manifest(spark, path)
    if held is None and path_exists(spark, path):
        raise ValueError(f"{path} exists but is not a keyed table; load it into a new path")
    raw = batch
    if order is not None:
        batch = last_per_key(batch, keys, order)
    given = schema or T.StructType([f for f in batch.schema.fields if f.name not in ENGINE_COLS])
    if held is None or not held["folders"]:
        n = n_buckets or buckets_for(*_coming(batch, expected_rows, expected_bytes, rows_per_bucket))
        target, everything = given, True
    else:
        old = T.StructType.fromJson(held["schema"])
        new_types = {f.name: f.dataType for f in given.fields}
        target = T.StructType([T.StructField(f.name, common_type(f.dataType, new_types[f.name], f.name) if f.name in new_types else f.dataType, True) for f in old.fields])
        target = T.StructType(target.fields + [T.StructField(f.name, f.dataType, True) for f in given.fields if f.name not in old.names])
        n = held["buckets"]
        coming, _, size = _coming(raw, expected_rows, expected_bytes, rows_per_bucket)
        rows, size = sum(held["rows"].values()) + coming, sum(held.get("bytes", {}).values()) + size
        while rows > n * rows_per_bucket or size > n * BYTES_PER_BUCKET:
            n *= 2
        widened = any(target[f.name].dataType != f.dataType for f in old.fields)
        everything = widened or n != held["buckets"]
    batch = _as_schema(batch, target).withColumn(BUCKET_COL, bucket_of(keys, n))
    folders = dict(held["folders"]) if held else {}
    if everything:
        touched, current = list(folders), _read_buckets(spark, path, T.StructType.fromJson(held["schema"]) if held else target, folders.values())
    else:
        # from the keys alone, at most a row per bucket
        bucket = _as_schema(raw.select(*[F.col(f"`{k}`") for k in keys]), T.StructType([target[k] for k in keys])).select(bucket_of(keys, n).alias(BUCKET_COL))
        touched = [str(r[0]) for r in bucket.distinct().collect()]
        current = _read_buckets(spark, path, target, [folders[b] for b in touched if b in folders])
    current = _as_schema(current, target).withColumn(BUCKET_COL, bucket_of(keys, n))
    put = f"data/{uuid.uuid4().hex}"
    # each bucket's rows in one task, so a bucket is one file
    whole, sized = upsert(current, batch, keys), Observation(f"bytes {uuid.uuid4().hex}")
    whole = whole.observe(sized, cell_bytes(whole).alias("bytes"))
    dealt = whole.repartitionById(n, BUCKET_COL) if everything else whole.repartition(max(len(touched), 1), BUCKET_COL)
    dealt.write.partitionBy(BUCKET_COL).parquet(f"{path.rstrip('/')}/{put}")
    rows = spark.read.schema(T.StructType([T.StructField(BUCKET_COL, T.IntegerType())])).parquet(f"{path.rstrip('/')}/{put}")
    written = {str(r[0]): r[1] for r in rows.groupBy(BUCKET_COL).count().collect()}
    if not written:
        return 0
    counts = {} if everything else {b: c for b, c in held["rows"].items() if b not in touched}
    sizes = {} if everything else {b: c for b, c in held.get("bytes", {}).items() if b not in touched}
    sizes |= {b: sized.get["bytes"] * c // sum(written.values()) for b, c in written.items()}
    folders = {} if everything else {b: f for b, f in folders.items() if b not in touched}
    folders |= {b: f"{put}/{BUCKET_COL}={b}" for b in written}
    version = held["version"] if held else None
    _publish(spark, path, version, {"buckets": n, "key": keys, "schema": target.jsonValue(), "folders": folders, "rows": counts | written, "bytes": sizes})
    _tidy(spark, path, 1 if version is None else version + 1)
    return len(written)


def land_as_files(spark: SparkSession, df: DataFrame, folder: str, table: str, parts: int | None = None, sep: str = ",", first: int | None = None) -> list[str]:
    """Write ``df`` as CSV files named like landed uploads (``table.csv`` or
    ``table_split__###.csv``, in partition order, from part ``first`` on) in
    ``folder``: Spark writes
    the part files, and the driver only renames them (one call per file).
    ``parts`` repartitions first; by default the frame's own partitioning
    (e.g. an ``orderBy``) is kept, so no task holds a whole table."""
    from ..operators.split import part_name

    staging = f"{folder.rstrip('/')}/_staging_{table}_{uuid.uuid4().hex[:8]}"
    out = df.repartition(parts) if parts else df
    writer = out.write.mode("errorifexists").option("header", True).option("escape", '"').option("sep", sep)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(staging)
    fs, sp = _fs(spark, staging)
    files = sorted(str(s.getPath()) for s in fs.listStatus(sp) if s.getPath().getName().endswith(".csv"))
    jvm = spark.sparkContext._jvm
    names = []
    for i, f in enumerate(files, start=first or 1):
        name = f"{table}.csv" if len(files) == 1 and first is None else part_name(table, i)
        dst = f"{folder.rstrip('/')}/{name}"
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.hadoop.fs.Path(dst)):
            raise OSError(f"could not land {f} as {dst}")
        names.append(dst)
    fs.delete(sp, True)
    return names
