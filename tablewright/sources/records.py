"""Records of delimited files whose quoted cells hold line breaks, read by
many tasks a file.

A file is scanned as lines, cut into blocks as any text. Whether a line begins
a record depends on whether a quoted cell is open before it, which only the
lines before can tell. So a first pass states for every block what it does to
both cases (a quoted cell open or not at its start), a window over the blocks
of a file (a row each) composes these and gives each block's true start, and a
second pass cuts every block's lines into records. A record that goes on into
the next blocks is put together from its pieces, which the first pass keeps.

A quote opens a cell only at the cell's start and a doubled quote inside a
quoted cell is a character, as in Spark's reader; cells are then parsed by
``from_csv``. Blank lines between records are skipped, the first record of a
file is its header, and line breaks inside cells are kept as they are. Texts
go through Arrow batches of lines; lines without a quote are passed on as
they come.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, workers_find_package

FILE, BLOCK, ROW = "_file", "_block", "_row"
#: Pieces up to this size are kept by the first pass; a longer one is read
#: again, by a pass for such pieces alone.
KEPT_CHARS = 1 << 20
#: Blocks whose starts are broadcast; with more, lines are dealt by block.
BROADCAST_BLOCKS = 1_000_000
SUMMARY = "_file string, _block long, opened boolean, ends boolean, through boolean, n long, head string, tail string, long boolean, breaks boolean"


def after_line(line: str, inside: bool, opener: str) -> bool:
    """Whether a quoted cell is open after ``line``; ``opener`` is the
    separator and a quote."""
    at = 0
    if not inside:
        if not line.startswith('"'):
            at = line.find(opener)
            if at < 0:
                return False
            at += len(opener) - 1
        at += 1
    while True:
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('"', at + 1):
            at += 2
            continue
        at = line.find(opener, at + 1)
        if at < 0:
            return False
        at += len(opener)


#: Bytes of lines that a Python worker takes at once: what it makes of them
#: (chosen lines, records, their order) stays small beside Arrow's batch.
SLICE_BYTES = 4 << 20


def slices(batches) -> Iterator:
    """The batches in slices of about ``SLICE_BYTES``, none kept behind."""
    for batch in batches:
        n = max(1, len(batch) * SLICE_BYTES // max(batch.nbytes, 1))
        for at in range(0, len(batch), n):
            yield batch.slice(at, n)


def block_runs(batch) -> Iterator[tuple]:
    """(file, block, first row, rows, lines) of each block's lines in a
    batch of (file, block, row, line)."""
    import numpy as np

    files = batch.column(0).dictionary_encode()
    code = files.indices.to_numpy(zero_copy_only=False)
    block = batch.column(1).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1), len(block)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield files.dictionary[int(code[a])].as_py(), int(block[a]), batch.column(2).slice(a, b - a), batch.column(3).slice(a, b - a)


def quoted_lines(lines) -> list[int]:
    """Places of the lines that hold a quote."""
    import numpy as np
    import pyarrow.compute as pc

    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist()


def blank(lines):
    """Which lines hold white space alone."""
    import pyarrow.compute as pc

    return pc.or_(pc.equal(pc.utf8_length(lines), 0), pc.utf8_is_space(lines)).to_numpy(zero_copy_only=False)


class Piece:
    """The lines of a record that reaches over a block's border."""

    def __init__(self, whole: bool):
        self.lines: list[str] = []
        self.size, self.whole, self.long = 0, whole, False

    def add(self, lines: list[str]) -> None:
        self.size += sum(map(len, lines))
        if self.size > KEPT_CHARS and not self.whole:
            self.lines, self.long = [], True
        elif not self.long:
            self.lines += lines

    def text(self) -> str:
        return "\n".join(self.lines)


class Block:
    """The lines of a block in order, from a start within a quoted cell
    (``opened``) or at a record. Counts the records that end in the block,
    without blank lines, and keeps the ``head``, which belongs to a record of
    an earlier block, and the ``tail``, which goes on in the next."""

    def __init__(self, opened: bool, opener: str, whole: bool = False):
        self.opened = self.inside = self.through = opened
        self.opener, self.whole, self.n = opener, whole, 0
        self.head = Piece(whole) if opened else None
        self.tail: Piece | None = None
        self.breaks = opened  # a line break that does not end a record

    def add(self, lines, quoted: list[int], is_blank) -> tuple:
        """Takes some lines; returns the places of the records of one line
        among them, and (place, text) of the longer ones that end there
        (place -1: begun before)."""
        import numpy as np

        singles, longer, begun, at = [], [], -1, 0
        for i in [*quoted, len(lines)]:
            if i > at:  # lines without a quote change nothing
                if self.inside:
                    (self.head if self.through else self.tail).add(lines.slice(at, i - at).to_pylist())
                else:
                    singles.append(at + np.flatnonzero(~is_blank[at:i]))
            if i == len(lines):
                break
            line, before = lines[i].as_py(), self.inside
            self.inside = after_line(line, before, self.opener)
            if self.through:
                self.head.add([line])
                self.through = self.inside
            elif before:
                self.tail.add([line])
                if not self.inside:
                    longer.append((begun, self.tail.text()))
                    self.tail = None
            elif self.inside:
                self.tail, begun, self.breaks = Piece(self.whole), i, True
                self.tail.add([line])
            else:
                singles.append(np.array([i]))
            at = i + 1
        places = np.concatenate(singles) if singles else np.zeros(0, dtype=np.int64)
        self.n += len(places) + len(longer)
        return places, longer

    def row(self) -> tuple:
        pieces = [x for x in (self.head, self.tail) if x is not None]
        head, tail = (x.text() if x is not None else None for x in (self.head, self.tail))
        return self.opened, self.inside, self.through, self.n, head, tail, any(x.long for x in pieces), self.breaks


def summaries(lines: DataFrame, opener: str, whole: bool = False) -> DataFrame:
    """What every block does to either case of its start."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        schema = pa.schema(
            [(FILE, pa.string()), (BLOCK, pa.int64()), ("opened", pa.bool_()), ("ends", pa.bool_()), ("through", pa.bool_()), ("n", pa.int64()), ("head", pa.string()), ("tail", pa.string()), ("long", pa.bool_()), ("breaks", pa.bool_())]
        )
        now, cases = None, []

        def out():
            columns = list(zip(*[(*now, *b.row()) for b in cases]))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in slices(batches):
            for file, block, _, text in block_runs(batch):
                if (file, block) != now:
                    if cases:
                        yield out()
                    now, cases = (file, block), [Block(opened, opener, whole) for opened in (False, True)]
                quoted, is_blank = quoted_lines(text), blank(text)
                returns = pc.any(pc.match_substring_regex(text, "\r[^\r]")).as_py()
                for b in cases:
                    b.add(text, quoted, is_blank)
                    b.breaks |= bool(returns)
        if cases:
            yield out()

    return lines.select(FILE, BLOCK, ROW, "value").mapInArrow(run, SUMMARY)


def block_starts(found: DataFrame) -> DataFrame:
    """``found`` (of ``summaries``) reduced to each block's true case, with
    ``owner``: the block in which the record begins that its head belongs to.

    A block leaves a quoted cell open, or closed, whatever was before; or it
    leaves things as they were; or it swaps them. So what is open before a
    block is what the last block that decides it left, swapped by those since."""
    cases = found.groupBy(FILE, BLOCK).agg(F.bool_or(F.when(~F.col("opened"), F.col("ends"))).alias("e0"), F.bool_or(F.when(F.col("opened"), F.col("ends"))).alias("e1"))
    order = Window.partitionBy(FILE).orderBy(BLOCK)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("e0") & ~F.col("e1")).cast("int")
    cases = cases.withColumn("swaps", F.sum(swap).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    decided = F.last(F.when(F.col("e0") == F.col("e1"), F.struct("e0", "swaps")), ignorenulls=True).over(before)
    cases = cases.select(FILE, BLOCK, decided.alias("d"), F.coalesce(F.lag("swaps").over(order), F.lit(0)).alias("s"))
    swapped = F.coalesce(F.col("s") - F.col("d.swaps"), F.col("s")) % 2 == 1
    cases = cases.select(FILE, BLOCK, (F.coalesce(F.col("d.e0"), F.lit(False)) != swapped).alias("opened"))
    true = found.join(cases, [FILE, BLOCK, "opened"])
    owner = F.last(F.when(~F.col("through"), F.col(BLOCK)), ignorenulls=True).over(before)
    return true.withColumn("owner", F.when(F.col("opened"), owner))


def bridged(starts: DataFrame) -> DataFrame:
    """(_file, _block, _row, record): the records that reach over a border,
    counted last in the block in which they begin."""
    tail = F.struct(F.when(F.col("tail").isNotNull(), F.col(BLOCK)).alias("owner"), F.lit(-1).cast("long").alias("at"), F.col("tail").alias("text"), F.col("n").alias("n"))
    head = F.struct(F.col("owner").alias("owner"), F.col(BLOCK).alias("at"), F.col("head").alias("text"), F.lit(None).cast("long").alias("n"))
    pieces = starts.select(FILE, F.inline(F.array(tail, head))).where("owner IS NOT NULL")
    joined = pieces.groupBy(FILE, "owner").agg(F.max("n").alias(ROW), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("pieces"))
    return joined.select(FILE, F.col("owner").alias(BLOCK), ROW, F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("record"))


def whole_records(lines: DataFrame, opener: str) -> DataFrame:
    """(_file, _block, _row, record): the records that end in the block in
    which they begin, numbered there; ``lines`` with ``opened``."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        now, state = None, None
        for batch in slices(batches):
            start = 0
            for file, block, _, text in block_runs(batch):
                if (file, block) != now:
                    now, state = (file, block), Block(batch.column(4)[start].as_py(), opener, whole=True)
                start += len(text)
                first = state.n
                places, longer = state.add(text, quoted_lines(text), blank(text))
                n = len(places) + len(longer)
                if n:
                    found = pa.concat_arrays([text.take(pa.array(places)), pa.array([x for _, x in longer], pa.string())])
                    order = np.argsort(np.concatenate([places, np.array([i for i, _ in longer], dtype=np.int64)]), kind="stable")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file] * n, pa.string()), pa.array(np.full(n, block)), pa.array(first + np.arange(n)), found.take(pa.array(order))], [FILE, BLOCK, ROW, "record"]
                    )

    return lines.select(FILE, BLOCK, ROW, "value", "opened").mapInArrow(run, "_file string, _block long, _row long, record string")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_records(spark: SparkSession, paths: list[str], sep: str, encoding: str | None, path: Column) -> DataFrame | None:
    """(_file, _block, _row, record) of delimited files: every record's text
    without the header, ordered by (_block, _row) within a file; None where
    every line is a record, as a reader of lines takes it. ``path`` is how a
    scanned file's path is spelled."""
    workers_find_package(spark)
    reader = spark.read.option("lineSep", "\n")
    # lines come as the file's bytes
    value = F.make_valid_utf8("value")
    if encoding and encoding.upper() != "UTF-8":
        reader = reader.option("encoding", encoding)
        value = F.decode(F.col("value").cast("binary"), encoding)
    lines = reader.text(paths).select(path.alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), F.monotonically_increasing_id().alias(ROW), value.alias("value"))
    opener = sep + '"'
    starts = _stored(block_starts(_stored(summaries(lines, opener), "record-blocks")), "record-starts")
    if starts.where("breaks").isEmpty():
        return None
    long = starts.where("long").select(FILE, BLOCK, "opened", "owner")
    if not long.isEmpty():  # pieces too long to be kept on sight
        again = summaries(_of_blocks(lines, long.select(FILE, BLOCK)), opener, whole=True)
        starts = starts.where("NOT long").unionByName(_stored(again.join(long, [FILE, BLOCK, "opened"]).select(starts.columns), "record-pieces"))
    whole = whole_records(_of_blocks(lines, starts.select(FILE, BLOCK, "opened")), opener)
    records = whole.unionByName(bridged(starts)).where(~((F.col(BLOCK) == 0) & (F.col(ROW) == 0)))
    text = F.when(F.endswith(F.col("record"), F.lit("\r")), F.expr("left(record, char_length(record) - 1)")).otherwise(F.col("record"))
    return records.withColumn("record", text)


def _of_blocks(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lines`` of ``blocks`` with their columns, each block's in order."""
    if blocks.count() <= BROADCAST_BLOCKS:  # a row per block: the scan's order is kept
        return lines.join(F.broadcast(blocks), [FILE, BLOCK])
    return lines.join(blocks, [FILE, BLOCK]).repartition(FILE, BLOCK).sortWithinPartitions(FILE, BLOCK, ROW)


def parse_records(records: DataFrame, schema: T.StructType, sep: str, corrupt: str | None = None) -> DataFrame:
    """The cells of ``record``, and the file order."""
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in schema.names)
    cells = F.from_csv("record", fields, options)
    return records.select(cells.alias("_cells"), FILE, BLOCK, ROW).select("_cells.*", FILE, BLOCK, ROW)
