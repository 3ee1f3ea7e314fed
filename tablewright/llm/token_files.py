"""Token ids of documents in binary packs with a shared zstandard dictionary.

Documents are range-partitioned and sorted by id; each task encodes its
documents, appends the end id and compresses every document by itself with
one dictionary that was trained on serialized id arrays. Consecutive
documents are laid into packs of about ``pack_bytes``; the packs are binary
values of a Parquet table that Spark's committer writes, so a lost executor
only repeats its tasks and any store that Spark writes to will do. Pack:

    magic ``TWTOK1``, id width in bytes (1 byte), sha256 of the dictionary,
    number of documents (8 bytes), offset index (``INDEX``, one record a
    document), frames one after the other

A document is fetched by its pack's id range, its index record and one frame.

Nulls and edges: a null text is an empty one (its ids are the end id alone);
rows with a null id come first and keep it; repeated rows are each written;
other columns are not read; an empty table gives an empty pack table.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_ready, texts
from .word_tokens import encoder

MAGIC = b"TWTOK1"
HEAD = len(MAGIC) + 1 + 32 + 8
#: ``start``: ids of the documents before it that the same task wrote.
INDEX = [("doc_id", "<i8"), ("no_id", "u1"), ("start", "<i8"), ("n_tokens", "<i8"), ("offset", "<i8"), ("length", "<i8")]
PACK_SCHEMA = "part int, seq int, first_id long, last_id long, n_docs long, n_tokens long, pack binary"


def id_width(tokenizer_path: str, end_id: int) -> int:
    return 2 if max(encoder(tokenizer_path).tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4


def serialize(ids: bytes, width: int) -> bytes:
    """Ids given as 32-bit integers, in ``width`` bytes each."""
    import numpy as np

    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def deserialize(raw: bytes, width: int) -> bytes:
    import numpy as np

    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int = 1, sample_docs: int = 2000, sample_chars: int = 20_000, dict_bytes: int = 64 << 10) -> bytes:
    """A zstandard dictionary from the id arrays of at most ``sample_docs``
    documents: of the ``4 * sample_docs`` smallest hashed ids those of at most
    ``sample_chars`` characters, and only if these are too few also longer
    ones, cut to that length (the dictionary serves short documents; it only
    affects file size). A corpus too small to train on gives the sample itself
    as the dictionary's content; only a corpus without ids gives none."""
    import zstandard

    python_ready(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    picked = [r[0] for r in docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(4 * sample_docs).collect()]
    if not picked:
        return b""
    width = id_width(tokenizer_path, end_id)
    end = array("I", [end_id]).tobytes()

    def encode(batches) -> Iterator:
        import pyarrow as pa

        enc = encoder(tokenizer_path)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "ids": pa.array([serialize(enc.encode(t) + end, width) for t in b.column(1).to_pylist()], pa.binary())})

    # of rows that share an id the shortest, combined before the shuffle
    chosen = docs.where(F.col("doc_id").isin(picked)).select("doc_id", F.left(text, F.lit(sample_chars)).alias("text"), F.char_length(text).alias("n"))
    chosen = chosen.groupBy("doc_id").agg(F.min_by("text", F.struct("n", F.xxhash64("text"))).alias("text"), F.min("n").alias("n"))
    chosen = chosen.orderBy(F.col("n") > sample_chars, F.xxhash64("doc_id"), "doc_id").limit(sample_docs).select("doc_id", "text").repartition(8)
    samples = [bytes(r[0]) for r in chosen.mapInArrow(encode, "doc_id long, ids binary").orderBy("doc_id").select("ids").collect()]
    try:
        return zstandard.train_dictionary(dict_bytes, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b"".join(samples)[-dict_bytes:].rjust(8, b"\0")


def _codec(dictionary: bytes, level: int | None = None):
    import zstandard

    shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    if level is None:
        return zstandard.ZstdDecompressor(**shared)
    return zstandard.ZstdCompressor(level=level, write_checksum=False, **shared)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, dictionary: bytes | None = None, pack_bytes: int = 1 << 20, level: int = 3) -> None:
    """Write ``docs`` (doc_id, text) as packs in ascending id order under
    ``path/packs``, and the dictionary under ``path/dictionary``."""
    import numpy as np

    spark = docs.sparkSession
    python_ready(spark)
    if dictionary is None:
        dictionary = train_dictionary(docs, tokenizer_path, end_id)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    width = id_width(tokenizer_path, end_id)
    end = array("I", [end_id]).tobytes()

    def pack(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc, press = encoder(tokenizer_path), _codec(dictionary, level)
        seq, start, size, index, frames = 0, 0, 0, [], []

        def closed():
            ids = [r[0] for r in index if not r[1]]
            body = MAGIC + bytes([width]) + digest + len(index).to_bytes(8, "little") + np.array(index, dtype=INDEX).tobytes() + b"".join(frames)
            row = (part, seq, ids[0] if ids else None, ids[-1] if ids else None, len(index), sum(r[3] for r in index), body)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["part", "seq", "first_id", "last_id", "n_docs", "n_tokens", "pack"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.encode(text) + end
                frame = press.compress(serialize(ids, width))
                index.append((doc_id or 0, doc_id is None, start, len(ids) // 4, size, len(frame)))
                frames.append(frame)
                start += len(ids) // 4
                size += len(frame)
                if size >= pack_bytes:
                    yield closed()
                    seq, size, index, frames = seq + 1, 0, [], []
        if index:
            yield closed()

    ordered = texts(docs).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(pack, PACK_SCHEMA).write.parquet(f"{path}/packs")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.schema("sha256 string, dictionary binary").parquet(f"{path}/dictionary").first()[1])


def unpack(pack: bytes, dictionary: bytes, wanted=None) -> Iterator[tuple]:
    """(doc_id, start within the writing task, ids as 32-bit integers) of a
    pack's documents, or only of those whose id is ``wanted``; other frames
    are not decompressed."""
    import numpy as np

    if pack[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token pack")
    width, digest, n = pack[len(MAGIC)], pack[len(MAGIC) + 1 : HEAD - 8], int.from_bytes(pack[HEAD - 8 : HEAD], "little")
    if hashlib.sha256(dictionary).digest() != digest:
        raise ValueError("the pack was written with another dictionary")
    index = np.frombuffer(pack, dtype=INDEX, count=n, offset=HEAD)
    body, codec = HEAD + index.nbytes, _codec(dictionary)
    for r in index:
        if wanted is None or (not r["no_id"] and r["doc_id"] == wanted):
            at = body + int(r["offset"])
            yield None if r["no_id"] else int(r["doc_id"]), int(r["start"]), deserialize(codec.decompress(pack[at : at + int(r["length"])]), width)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per written document: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 and, on demand, ids (32-bit integers)."""
    python_ready(spark)
    dictionary = read_dictionary(spark, path)
    packs = spark.read.schema(PACK_SCHEMA).parquet(f"{path}/packs")
    # one row per writing task: its first id's place among all ids
    parts = packs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = {}
    at = 0
    for r in parts.orderBy("part").collect():  # one row per writing task
        offsets[r["part"]] = at
        at += r["n"]

    def read(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for part, pack in zip(b.column(0).to_pylist(), b.column(1)):
                rows = list(unpack(pack.as_py(), dictionary))
                cols = {
                    "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                    "start": pa.array([r[1] + offsets[part] for r in rows], pa.int64()),
                    "n_tokens": pa.array([len(r[2]) // 4 for r in rows], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(r[2]) for r in rows], pa.int64()),
                }
                if with_ids:
                    cols["ids"] = pa.array([r[2] for r in rows], pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return packs.select("part", "pack").mapInArrow(read, schema)


def fetch_document(spark: SparkSession, path: str, doc_id: int) -> list[array]:
    """The id arrays of one document (one per written row of that id): only
    packs whose id range holds it are read, only its frames decompressed."""
    dictionary = read_dictionary(spark, path)
    packs = spark.read.schema(PACK_SCHEMA).parquet(f"{path}/packs").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    found = []
    for r in packs.select("pack").orderBy("part", "seq").toLocalIterator():
        for _, _, ids in unpack(bytes(r[0]), dictionary, doc_id):
            found.append(array("I", ids))
    return found
