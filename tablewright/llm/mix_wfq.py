"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order (a seeded hash of
the id), up to ``max_repeats`` passes long. A document's virtual finish time
is its source's cumulative words up to its end, divided by the source's
target. All passes are range-sorted globally by finish time, and the sorted
stream is cut at the total budget: what has finished by then is taken whole,
and of the one document a source has in service its words served by then.
So each source takes its target, and a rerun takes the same words.

Cumulative sums are distributed: rows are range-sorted, each partition sums
up its own rows, and only partition totals (a row per partition and source)
are summed in order. A hot source is spread over many partitions.

Nulls and edges: a null text has size 0; a null source is a source of its
own, last in order; a document of size 0 takes 0 words; rows that repeat an
id are mixed as rows of their own; an empty table gives an empty mix; other
columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Words: runs of other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SEED = "wfq:"


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words of the whole text)."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """source, source_size and target, a row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and
    share ``share`` times all words; no target exceeds ``max_repeats`` times
    its source's size, the excess is shared again by weight. That is one
    level L with target = min(limit, L * weight): sources are sorted by
    limit / weight, and L leaves a source at its limit exactly if all the
    budget not taken by sources before it gives it at least that much. The
    windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.lit(list(weights))
    per = per.withColumn("weight", F.get(w, ((F.row_number().over(in_order) - 1) % len(weights)).cast("int")).cast("double"))
    per = per.withColumn("limit", F.col("source_size") * F.lit(float(max_repeats)))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("budget", F.sum("source_size").over(every) * F.lit(share))
    per = per.withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / F.sum("weight").over(rest))
    # the first source whose limit is above its share sets the level of all
    # that follow; of the later ones, taken for open as well, it is the highest
    per = per.withColumn("open", F.col("limit") > F.col("level") * F.col("weight"))
    per = per.withColumn("at", F.max(F.when(F.col("open"), F.col("level"))).over(every))
    per = per.withColumn("target", F.when(F.col("at").isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("at") * F.col("weight"))))
    return per.select("source", "source_size", "target")


def shuffle_key(doc_id):
    """A document's place in its source's queue: a seeded hash of its id."""
    return F.md5(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def running_sum(rows: DataFrame, order: list[str], value: str, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of the same
    ``by`` up to and with this one, in ``order`` (which starts with ``by``).

    The range-sorted rows are written once; each partition sums up its own
    rows, and the totals, a row per partition and ``by``, are summed in
    order. The totals are a table of known size, so Spark broadcasts them
    only if they are small."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed.withColumn("_part", F.shiftright("_at", 33)), f"mix-{name}")
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part", *by).agg(F.sum(value).alias("_sum"))
    totals = totals.select(*[F.col(k).alias(f"_of_{k}") for k in ("_part", *by)], F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    totals = written(totals.coalesce(1), f"mix-{name}-totals")
    within = Window.partitionBy("_part", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in ("_part", *by)])
    summed = placed.withColumn("_own", F.sum(value).over(within)).join(totals, same)
    return summed.select(*rows.columns, (F.col("_own") + F.col("_before")).alias(name))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words of the
    document in the mix, its repeats counted), a row per document."""
    sizes = written(sized(docs).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    return mix_rows(sizes, weights, share, max_repeats).drop("row", "shuffled")


def mix_rows(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """``mix`` of (doc_id, source, size, row), with the row's number and its
    place in its source's queue."""
    targets = written(source_targets(sizes, weights, share, max_repeats).coalesce(1), "mix-targets")
    queued = sizes.withColumn("shuffled", shuffle_key(F.col("doc_id")))
    queued = running_sum(queued, ["source", "shuffled", "doc_id", "size", "row"], "size", ["source"], "cum")
    of_source = targets.select(F.col("source").alias("_source"), "source_size", "target")
    queued = queued.join(of_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # only passes that begin before the source has had its target can be in service at the cut
    passes = queued.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    passes = passes.withColumn("start", F.col("pass") * F.col("source_size") + F.col("cum") - F.col("size")).where("start < target")
    passes = passes.select(
        "row",
        "pass",
        "shuffled",
        ((F.col("start") + F.col("size")) / F.col("target")).alias("finish"),
        F.least(F.col("size"), F.ceil(F.col("target") - F.col("start"))).alias("words"),
    )
    stream = running_sum(passes, ["finish", "shuffled", "pass", "row"], "words", [], "sent")
    words = targets.agg(F.sum("source_size")).first()[0] or 0
    budget = min(math.floor(share * words), max_repeats * words)  # the sum of all targets, in whole words
    cut = F.least(F.col("words"), F.lit(budget) - (F.col("sent") - F.col("words")))
    taken = stream.withColumn("words", cut).where("words > 0").groupBy("row").agg(F.sum("words").alias("taken"))
    out = queued.join(taken, "row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "row", "shuffled")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a
    document is taken, and the document a source has in service at the cut
    with the words it was given (its ``n_chars``, if there, made to fit).

    A source's queue is taken up to one place, so the mix is stated by one
    row per source: the whole passes and the last document of the next. The
    documents are written once with a row number, which tells rows apart that
    share an id or have none; they stay where they are and look up their
    source."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # the document travels as one struct, so its columns clash with nothing here
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), F.col("source").alias("queue"), F.col("text").alias("body"), size.alias("words"))
    rows = written(rows.drop("body").withColumn("row", F.monotonically_increasing_id()), "mix-documents")
    shares = mix_rows(rows.select(F.col("id").alias("doc_id"), F.col("queue").alias("source"), F.col("words").alias("size"), "row"), weights, share, max_repeats)
    whole = F.floor(F.col("target") / F.col("source_size"))
    place = F.struct(F.col("shuffled").alias("key"), F.col("doc_id").alias("id"), "size", "row", "taken")
    per = shares.where("size > 0").withColumn("whole", whole).groupBy("source").agg(
        F.max("whole").alias("whole"), F.max(F.when(F.col("taken") > F.col("whole") * F.col("size"), place)).alias("last")
    )
    per = written(per.withColumnRenamed("source", "of").coalesce(1), "mix-cuts")
    mine = F.struct(shuffle_key(F.col("id")).alias("key"), "id", F.col("words").alias("size"), "row")
    last = F.struct("last.key", "last.id", "last.size", "last.row")
    taken = (
        F.when(F.col("last").isNull() | (mine > last), F.col("whole") * F.col("words"))
        .when(mine < last, (F.col("whole") + 1) * F.col("words"))
        .otherwise(F.col("last.taken"))
    )
    rows = rows.join(per, F.col("queue").eqNullSafe(F.col("of"))).withColumn("taken", taken).withColumn("body", F.col("doc.text"))
    rows = rows.where("words > 0 AND taken > 0")
    rows = rows.withColumn("served", F.explode(F.expr("transform(sequence(0L, (taken - 1) div words), p -> least(words, taken - p * words))")))
    cut = F.col("served") < F.col("words")
    pieces = F.slice(F.regexp_extract_all("body", F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)), F.lit(1), F.col("served").cast("int"))
    text = F.when(cut, F.array_join(pieces, "")).otherwise(F.col("body"))
    out = {c: F.col("doc").getField(c) for c in docs.columns}
    out["text"] = text
    if "n_chars" in out:
        out["n_chars"] = F.when(cut, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    return rows.select(*[x.alias(c) for c, x in out.items()])
