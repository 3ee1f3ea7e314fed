"""Available-now stream ingest of a landing folder: O-73.

The stream delivers the names of new files (its checkpoint remembers them);
each batch of files goes through the gate of the folder load: every file is
read by its own header, whatever the order of its columns, and in its own
encoding; a file whose header is not the table's, whose key fails, that has
records longer than the header or cells that do not fit fails as a whole,
with the reason in the ledger; the others are upserted in file order and
logged as done. A retried batch re-puts the same rows, so the result is the
same. Files are archived by the source (``cleanSource=archive``). Completion
is judged by the checkpoint and the ledger, not by an empty folder: archiving
lags one batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import base_name, table_name_of
from ..functions.patterns import NA_TOKENS
from ..operators.items import sidecar_rows
from ..options import LoadOptions
from ..plans.folder import FileGroup, gate
from ..sinks import ledger as led
from ..sinks import tables
from ..sources.delimited import CORRUPT_COL, FILE_ORDER, Layout, file_layouts, read_delimited

LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(
    spark: SparkSession,
    input_path: str,
    names: Sequence[str],
    table_path: str,
    checkpoint: str,
    ledger_path: str,
    meta=None,
    archive_dir: str | None = None,
    max_files_per_trigger: int = 100,
    sep: str = ",",
    glob: str = "*.csv",
    multi_line: bool = False,
    rows_per_bucket: int = tables.ROWS_PER_BUCKET,
    encoding: str | None = None,
    strict_key: bool = False,
    na_tokens=NA_TOKENS,
) -> None:
    """Run one available-now pass over ``input_path`` and wait for it.

    ``names`` are the table's columns: a file must have them all and no
    others, in any order. ``meta`` is an optional sidecar (rows
    ``(name, tag[, dtype])``, by position of ``names``); without it cells
    stay text. The first column is the key; a text key is accepted unless
    ``strict_key``."""
    reader = spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    names = list(names)
    rows = [(n, "S", "object") for n in names] if meta is None else sidecar_rows(meta) if isinstance(meta, DataFrame) else [tuple(r) + (None,) * (3 - len(r)) for r in meta]
    opts = LoadOptions(input_path=input_path, output_path=table_path, ledger_path=ledger_path, sep=sep, multi_line=multi_line, strict_key=strict_key, na_tokens=tuple(na_tokens))

    def log(done: list[tuple]) -> None:
        if done:
            frame = spark.createDataFrame(done, "path string, n_rows bigint, status string, message string")
            led.append_ledger(spark, ledger_path, frame.withColumn("table_name", table_name_of(base_name(F.col("path")))))

    def put_batch(batch: DataFrame, batch_id: int) -> None:
        lengths = {r["path"]: r["length"] for r in batch.select("path", "length").collect()}  # at most max_files_per_trigger
        paths = sorted(lengths)
        if not paths:
            return
        layouts = file_layouts(spark, paths, sep, encoding, multi_line)
        failed = {p: "the file has no header" for p in paths if p not in layouts}
        failed |= {p: f"columns {list(x.names)}, not {names}" for p, x in layouts.items() if sorted(x.names) != sorted(names)}
        read: dict[Layout, list[str]] = {}
        for p in paths:
            if p not in failed:
                read.setdefault(layouts[p], []).append(p)
        groups = []
        for layout, ps in read.items():
            df = read_delimited(spark, ps, sep, layout.encoding, multi_line and layout.quotes, layout.names, file_order=True, corrupt=True)
            by_name = df.select(*[F.col(f"`{n}`") for n in names], *FILE_ORDER, CORRUPT_COL)
            groups.append(FileGroup(by_name, names, rows))
        counts = {}
        if groups:
            gated = gate(spark, groups, opts)
            failed |= gated.failed
            counts = gated.counts
            n_rows = sum(n for p, n in counts.items() if p not in failed)
            if n_rows:
                tables.upsert_table(spark, table_path, gated.frame, gated.key, order=[F.col(c) for c in FILE_ORDER], expected_rows=n_rows, rows_per_bucket=rows_per_bucket, expected_bytes=sum(lengths[p] for p in counts if p not in failed))
        log([(p, None, "failed", failed[p]) if p in failed else (p, counts.get(p, 0), "done", f"batch {batch_id}") for p in paths])

    q = reader.load(input_path).writeStream.foreachBatch(put_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
