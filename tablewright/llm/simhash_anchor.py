"""SimHash near-duplicates by anchor-point covering.

Anchors are the codewords of the perfect Hamming code of length 31: every
31-bit word lies within 1 bit (the covering radius) of exactly one of them. A
fingerprint is cut into two 31-bit halves (two bits are left to the final
comparison). If two fingerprints differ in at most 3 bits, one half differs
in at most 1. So each distinct fingerprint lies, per half, at its home anchor
and is replicated to every anchor within covering radius plus that threshold,
2 bits (at most 16); home rows meet replicas per anchor and the whole 64 bits
are compared. Copies share one fingerprint and are collapsed first. Distinct
fingerprints have at most 43,744 others within 3 bits, so links grow with the
number of fingerprints, not with its square.

Nulls and edges: a null or word-less text has fingerprint zero and is linked
like any other; a class of documents without ids has a null component id;
repeated rows are each returned; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, texts, written
from .components import connected_components

SEED = 42
HALF_BITS = 31
#: Shingle hashes whose bits are counted at a time.
COUNT_BLOCK = 1 << 15


def fingerprint(text: str, shingle: int = 3) -> int:
    """The text's SimHash as an unsigned integer: ASCII lower case, words
    between ASCII white space, XXH64 of every shingle, majority of each bit."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    h = np.array([xxh64_intdigest(g, SEED) for g in grams], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), COUNT_BLOCK):
        ones += np.unpackbits(h[at : at + COUNT_BLOCK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer, row by row."""
    python_ready(docs.sparkSession)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def _syndrome(x: Column) -> Column:
    """The Hamming syndrome of a 31-bit word: 0 for a codeword, else the
    1-based place of the bit that leads to its codeword."""
    out = None
    for k in range(HALF_BITS.bit_length()):
        mask = sum(1 << (p - 1) for p in range(1, HALF_BITS + 1) if p >> k & 1)
        bit = F.shiftleft(F.bit_count(x.bitwiseAND(F.lit(mask).cast("long"))).bitwiseAND(F.lit(1)).cast("long"), k)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def _halves(fps: DataFrame) -> DataFrame:
    """(fp, half, word, syndrome), two rows per fingerprint."""
    mask = F.lit((1 << HALF_BITS) - 1).cast("long")
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.col("fp").bitwiseAND(mask).alias("word")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned("fp", HALF_BITS).bitwiseAND(mask).alias("word")),
    )
    return fps.select("fp", F.inline(halves)).withColumn("syndrome", _syndrome(F.col("word")))


def home_anchors(fps: DataFrame) -> DataFrame:
    """(half, anchor, fp): the one codeword within the covering radius."""
    home = "CASE WHEN syndrome = 0 THEN word ELSE word ^ shiftleft(1L, CAST(syndrome - 1 AS INT)) END"
    return _halves(fps).select("half", F.expr(home).alias("anchor"), "fp")


def near_anchors(fps: DataFrame) -> DataFrame:
    """(half, anchor, fp) for every codeword within 2 bits: the home anchor
    and, off a codeword, those reached by flipping two bits whose places
    combine to the syndrome."""
    pairs = (
        "CASE WHEN syndrome = 0 THEN array(word) ELSE concat(array(word ^ shiftleft(1L, CAST(syndrome - 1 AS INT))), "
        f"transform(filter(sequence(1L, {HALF_BITS}L), p -> p < (p ^ syndrome)), "
        "p -> word ^ shiftleft(1L, CAST(p - 1 AS INT)) ^ shiftleft(1L, CAST((p ^ syndrome) - 1 AS INT)))) END"
    )
    return _halves(fps).select("half", F.explode(F.expr(pairs)).alias("anchor"), "fp")


def linked_fingerprints(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b), a < b: distinct fingerprints ``fps`` that differ in at most
    ``max_bits`` bits (3 at most: one of two halves then differs in 1)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves cover distances up to 3")
    a, b = home_anchors(fps).alias("a"), near_anchors(fps).alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    met = a.join(b, (F.col("a.half") == F.col("b.half")) & (F.col("a.anchor") == F.col("b.anchor")) & (F.col("a.fp") < F.col("b.fp")) & near)
    return met.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def component_labels(marked: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, component, component_id) of the distinct fingerprints of
    ``marked`` (doc_id, fp): the component's smallest fingerprint and the
    smallest doc_id that is reachable."""
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = linked_fingerprints(classes.select("fp"), max_bits)
    labels = connected_components(links)  # node, component: linked fingerprints only
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.select("fp", "component").join(least, "component")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id that is reachable
    over links of at most ``max_bits`` differing bits."""
    marked = written(fingerprints(docs, shingle), "simhash-fp")
    return marked.join(component_labels(marked, max_bits).select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def with_fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc, doc_id, fp): every row as one struct beside its fingerprint."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc", "doc_id", "fp"])

    out = T.StructType([rows.schema["doc"], rows.schema["doc_id"], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, out)


def keep_one_per_component(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: that with the
    smallest doc_id (rows without one last), and of rows that share that id
    one with the smallest fingerprint. Rows are told by id and fingerprint
    together, so an id that stands on two texts harms neither; rows without
    an id are judged like others."""
    marked = written(fingerprints(docs, shingle), "simhash-fp")
    named = marked.groupBy("doc_id", "fp").agg(F.count("*").alias("copies")).join(component_labels(marked, max_bits), "fp")
    stays = named.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component")
    stays = stays.agg(F.min(F.struct("fp", "copies")).alias("first"), F.first("component_id").alias("stays_id"))
    # written, so that Spark knows its size when it chooses the join
    stays = written(stays.select(F.col("first.fp").alias("stays_fp"), "stays_id", F.col("first.copies").alias("copies")), "simhash-stays")
    # the fingerprint of a text is the same in both passes: no copy of the texts is kept
    kept = with_fingerprints(docs, shingle).join(stays, (F.col("fp") == F.col("stays_fp")) & F.col("doc_id").eqNullSafe(F.col("stays_id")))
    once = kept.where("copies = 1").select("doc")
    if stays.where("copies > 1").isEmpty():
        return once.select("doc.*")
    several = kept.where("copies > 1").groupBy("stays_fp", "stays_id").agg(F.first("doc").alias("doc")).select("doc")
    return once.unionByName(several).select("doc.*")
