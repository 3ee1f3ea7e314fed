"""Language identification by averaged hashed subword embeddings.

A text's features are its hashed character n-grams (2 to 4 letters, words
with their edges); their embeddings are averaged and a linear softmax names
the language. Embeddings and softmax are trained together by stochastic
gradient descent in numpy on a bounded sample: at most ``sample_rows``
documents, spread over the languages, those with the smallest hashed ids. A
part of the sample is set aside for calibration: it gives the softmax's
temperature and the score below which a prediction is marked as rejected.
Trained, embedding and softmax fold into one score table per n-gram bucket.

Nulls and edges: a null text or one without a letter is ``und`` with score 0;
so is every text if there is nothing to learn from; rows without a language
or an id are not learned from; repeated rows are each returned; other columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import python_ready, texts, written

UNDETERMINED = "und"
BUCKETS = 1 << 15
SIZES = (2, 3, 4)
#: Code points hashed at a time.
BLOCK = 1 << 20
ASCII_LETTER = re.compile("[A-Za-z]")


@lru_cache(maxsize=1)
def _letters():
    import numpy as np

    return np.array([chr(c).isalpha() for c in range(0x10000)])


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def bucket_counts(text: str):
    """How often each n-gram bucket occurs in the whole text."""
    import numpy as np

    counts = np.zeros(BUCKETS, dtype=np.int64)
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.where(_letters()[np.minimum(c, 0xFFFF)] | (c > 0xFFFF), c, 32).astype(np.uint32)
    for at in range(0, len(c), BLOCK):
        part = c[at : at + BLOCK + max(SIZES) - 1]
        inner = (part[:-1] != 32) | (part[1:] != 32)  # not between two blanks
        h = part * np.uint32(0x9E3779B1)
        for size in range(2, max(SIZES) + 1):
            if len(part) < size:
                break
            h = (h[: len(part) - size + 1] ^ part[size - 1 :]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
            if size in SIZES:
                own = h[: BLOCK][inner[: len(h)][:BLOCK]]
                counts += np.bincount(own & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return counts


class LanguageModel:
    """``predict(texts)``: languages, calibrated scores and rejections."""

    def __init__(self, dim: int = 16, epochs: int = 6, rate: float = 1.0, seed: int = 0):
        self.dim, self.epochs, self.rate, self.seed = dim, epochs, rate, seed
        self.langs: list[str] = []

    def fit(self, rows: list[tuple]):
        """``rows``: (buckets, counts, language); every fifth row calibrates."""
        import numpy as np

        self.langs = sorted({r[2] for r in rows})
        if not self.langs:
            return self
        place = {x: i for i, x in enumerate(self.langs)}
        rng = np.random.default_rng(self.seed)
        embed = rng.normal(0, 0.1, (BUCKETS, self.dim)).astype(np.float32)
        soft = rng.normal(0, 0.1, (self.dim, len(self.langs))).astype(np.float32)
        data = [(np.asarray(b), (np.asarray(n) / max(1, np.sum(n))).astype(np.float32), place[x]) for b, n, x in rows]
        held = data[::5] if len(data) >= 10 else data
        learned = [d for i, d in enumerate(data) if i % 5] if len(data) >= 10 else data
        steps, done = max(1, self.epochs * len(learned)), 0
        for _ in range(self.epochs):
            for i in rng.permutation(len(learned)):
                buckets, share, lang = learned[i]
                rate = self.rate * (1 - done / steps)
                done += 1
                mean = share @ embed[buckets]
                z = mean @ soft
                p = np.exp(z - z.max())
                p /= p.sum()
                p[lang] -= 1
                back = soft @ p
                soft -= rate * np.outer(mean, p)
                # a bucket's share is small, so its embedding takes a longer step
                embed[buckets] -= (rate * min(50.0, len(buckets))) * np.outer(share, back)
        self.table = (embed @ soft).astype(np.float32)
        self._calibrate(held)
        return self

    def _calibrate(self, held) -> None:
        import numpy as np

        z = np.array([share @ self.table[buckets] for buckets, share, _ in held])
        y = np.array([lang for _, _, lang in held])

        def probs(t):
            e = np.exp((z - z.max(1, keepdims=True)) / t)
            return e / e.sum(1, keepdims=True)

        loss = lambda t: -np.log(np.maximum(probs(t)[np.arange(len(y)), y], 1e-9)).mean()
        self.temperature = float(min(np.geomspace(0.05, 5, 40), key=loss))
        p = probs(self.temperature)
        right = p.argmax(1) == y
        score = p.max(1)
        # the lowest score from which on at most 1 % of predictions are wrong
        order = np.argsort(-score)
        wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(wrong <= 0.01)
        self.floor = float(score[order[good[-1]]]) if len(good) else 1.0
        if len(good) == len(order):
            self.floor = min(self.floor, 0.5)

    def predict(self, batch: list[str]) -> list[tuple]:
        import numpy as np

        out = []
        for text in batch:
            if not self.langs or not has_letter(text):
                out.append((UNDETERMINED, 0.0, True))
                continue
            counts = bucket_counts(text)
            z = (counts @ self.table) / max(1, counts.sum()) / self.temperature
            p = np.exp(z - z.max())
            p /= p.sum()
            best = int(p.argmax())
            out.append((self.langs[best], float(p[best]), bool(p[best] < self.floor)))
        return out


def train(docs: DataFrame, learnable: Column | None = None, sample_rows: int = 3000) -> LanguageModel:
    """A model from documents with a language that are ``learnable`` (a
    condition on doc_id). Ids are picked first; the picked texts become
    bucket counts on the workers."""
    python_ready(docs.sparkSession)
    given = docs.select("doc_id", "lang").where("doc_id IS NOT NULL AND lang IS NOT NULL")
    if learnable is not None:
        given = given.where(learnable)
    given = given.distinct()  # rows that repeat an id are one
    sizes = written(given.groupBy("lang").agg(F.count("*").alias("n")).coalesce(1), "language-sizes")
    each = max(1, sample_rows // max(1, sizes.count()))
    # of a frequent language only low hashes, about four times what is needed,
    # go into the ranking: no task ranks a whole language
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    shares = sizes.select(F.col("lang").alias("_lang"), F.least(F.lit(1.0), F.lit(4.0 * each) / F.col("n")).alias("share"))
    drawn = given.join(shares, F.col("lang") == F.col("_lang")).where(draw)
    order = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id")
    picked = drawn.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each).select("doc_id", "lang", "k")
    picked = written(picked.orderBy("k", "lang").limit(sample_rows).select("doc_id", F.col("lang").alias("given")).coalesce(1), "language-sample")

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            rows = []
            for text in b.column(2).to_pylist():
                counts = bucket_counts(text)
                at = np.flatnonzero(counts)
                rows.append((at.astype(np.int32), counts[at].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int32()))], ["doc_id", "given", "buckets", "counts"])

    # at most sample_rows ids: a bounded broadcast; of rows that share an id
    # and a language one is learned from, combined before the shuffle
    rows = texts(docs, "lang").join(F.broadcast(picked), "doc_id").where("lang = given")
    rows = rows.groupBy("doc_id", "given").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = rows.mapInArrow(run, "doc_id long, given string, buckets array<int>, counts array<int>").toPandas()
    got = got.sort_values(["doc_id", "given"], kind="stable")
    return LanguageModel().fit([r for r in zip(got["buckets"], got["counts"], got["given"]) if len(r[0])])


def identified(docs: DataFrame, model: LanguageModel, *more: Column) -> DataFrame:
    """doc_id, ``more``, lang_pred, score and rejected, a row per document."""
    python_ready(docs.sparkSession)
    rows = texts(docs, *more)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            got = list(zip(*model.predict(b.column("text").to_pylist()))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(got[0], pa.string()), pa.array(got[1], pa.float64()), pa.array(got[2], pa.bool_())], [*[f.name for f in kept], "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(run, schema)
