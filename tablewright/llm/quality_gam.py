"""Text quality by a generalised additive model with pairwise interactions.

Labels are learned from a bounded sample: at most ``sample_rows`` labelled
documents, those with the smallest hashed ids. Cyclic boosting takes the
features in turn and adds one shallow tree (up to three leaves) on the binned
feature to that feature's lookup table; the pairs whose residuals gain most
then get tables of their own from trees with one cut per feature. A document
is scored by adding up table entries of its bins, for a batch at a time.

Nulls and edges: a null text counts as empty and is scored like any text;
labels without an id or value are not learned from; an id labelled twice
gives two rows; without both classes in the sample every score is the
sample's mean (0.5 without rows); other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_ready, texts, written

FEATURES = (
    "log_chars",
    "log_words",
    "word_length",
    "upper_share",
    "digit_share",
    "sign_share",
    "symbol_share",
    "shout_share",
    "bar_share",
    "dup_line_share",
    "distinct_words",
    "repeated_trigrams",
    "ended_lines",
    "log_line_chars",
    "log_longest_word",
    "beyond_ascii",
    "short_words",
    "byte_entropy",
)
LINE_END = re.compile(r"[.!?:;\"')\]]\s*$")


def features(text: str) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    import numpy as np

    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, chars = len(words), max(1, len(text))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    upper, lower = hist[65:91].sum(), hist[97:123].sum()
    signs = hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()
    symbols = sum(int(hist[ord(c)]) for c in "#*$%&|<>")
    lines = [x for x in text.split("\n") if x.strip()]
    p = hist[hist > 0] / max(1, len(raw))
    grams = n - 2
    return [
        math.log1p(len(text)),
        math.log1p(n),
        sum(map(len, words)) / max(1, n),
        float(upper) / max(1, upper + lower),
        float(hist[48:58].sum()) / chars,
        float(signs) / chars,
        symbols / chars,
        float(hist[33] + hist[63]) / max(1, n),
        float(hist[124]) / max(1, n),
        1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
        len(set(words)) / max(1.0, n**0.8),
        1 - len(set(zip(words, words[1:], words[2:]))) / grams if grams > 0 else 0.0,
        sum(1 for x in lines if LINE_END.search(x[-8:])) / max(1, len(lines)),
        math.log1p(len(text) / max(1, len(lines))),
        math.log1p(max(map(len, words), default=0)),
        float(hist[128:].sum()) / max(1, len(raw)),
        sum(1 for w in words if len(w) <= 3) / max(1, n),
        float(-(p * np.log2(p)).sum()),
    ]


def feature_matrix(batch: list[str]):
    import numpy as np

    return np.array([features(t) for t in batch], dtype=np.float64).reshape(len(batch), len(FEATURES))


def _leaves(g, h, reg: float):
    """Leaf values, per bin, of the best tree with up to two cuts on one
    binned feature; ``g`` and ``h`` are its gradient and curvature sums."""
    import numpy as np

    def cut(lo: int, hi: int):
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        if hi - lo < 2:
            return 0.0, lo
        left = cg[:-1] ** 2 / (ch[:-1] + reg)
        right = (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + reg)
        gain = left + right - cg[-1] ** 2 / (ch[-1] + reg)
        best = int(np.argmax(gain))
        return float(gain[best]), lo + best + 1

    _, a = cut(0, len(g))
    (gain_l, l), (gain_r, r) = cut(0, a), cut(a, len(g))
    edges = sorted({0, a, l if gain_l >= gain_r else r, len(g)})
    out = np.zeros(len(g))
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + reg)
    return out


def _quadrants(g, h, reg: float):
    """(gain, values) of the best pair of cuts, one per feature, on a grid."""
    import numpy as np

    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts_g = [cg[:-1, :-1], cg[:-1, -1:] - cg[:-1, :-1], cg[-1:, :-1] - cg[:-1, :-1], cg[-1, -1] - cg[:-1, -1:] - cg[-1:, :-1] + cg[:-1, :-1]]
    parts_h = [ch[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1], ch[-1, -1] - ch[:-1, -1:] - ch[-1:, :-1] + ch[:-1, :-1]]
    gain = sum(a**2 / (b + reg) for a, b in zip(parts_g, parts_h))
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    v = [a[i, j] / (b[i, j] + reg) for a, b in zip(parts_g, parts_h)]
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gain[i, j]), out


class AdditiveModel:
    """``score(x)``: probability of label 1 for rows of ``FEATURES``."""

    def __init__(self, bins: int = 48, pair_bins: int = 12, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 6, rate: float = 0.1, reg: float = 5.0):
        self.bins, self.pair_bins, self.rounds, self.pair_rounds = bins, pair_bins, rounds, pair_rounds
        self.n_pairs, self.rate, self.reg = n_pairs, rate, reg

    def _binned(self, x, edges):
        import numpy as np

        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)

    def fit(self, x, y):
        import numpy as np

        n, self.prior = len(y), float(np.mean(y)) if len(y) else 0.5
        self.tables, self.pairs = [], []
        if n == 0 or self.prior in (0.0, 1.0):
            return self
        cuts = lambda k: [np.unique(np.quantile(x[:, f], np.linspace(0, 1, k + 1)[1:-1])) for f in range(x.shape[1])]
        self.edges, self.pair_edges = cuts(self.bins), cuts(self.pair_bins)
        b, c = self._binned(x, self.edges), self._binned(x, self.pair_edges)
        self.base = math.log(self.prior / (1 - self.prior))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        z = np.full(n, self.base)

        def slopes():
            p = 1 / (1 + np.exp(-z))
            return y - p, p * (1 - p)

        for _ in range(self.rounds):
            for f, table in enumerate(self.tables):
                g, h = slopes()
                k = len(table)
                step = self.rate * _leaves(np.bincount(b[:, f], g, k), np.bincount(b[:, f], h, k), self.reg)
                table += step
                z += step[b[:, f]]

        def grid(i, j, g, h):
            ki, kj = len(self.pair_edges[i]) + 1, len(self.pair_edges[j]) + 1
            at = c[:, i] * kj + c[:, j]
            return at, np.bincount(at, g, ki * kj).reshape(ki, kj), np.bincount(at, h, ki * kj).reshape(ki, kj)

        g, h = slopes()
        gains = [(_quadrants(*grid(i, j, g, h)[1:], self.reg)[0], i, j) for i in range(x.shape[1]) for j in range(i)]
        for _, i, j in sorted(gains, reverse=True)[: self.n_pairs]:
            self.pairs.append((i, j, np.zeros((len(self.pair_edges[i]) + 1, len(self.pair_edges[j]) + 1))))
        for _ in range(self.pair_rounds):
            for i, j, table in self.pairs:
                g, h = slopes()
                at, gg, hh = grid(i, j, g, h)
                step = self.rate * _quadrants(gg, hh, self.reg)[1]
                table += step
                z += step.ravel()[at]
        return self

    def score(self, x):
        import numpy as np

        if not self.tables:
            return np.full(len(x), self.prior)
        b, c = self._binned(x, self.edges), self._binned(x, self.pair_edges)
        z = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            z += table[b[:, f]]
        for i, j, table in self.pairs:
            z += table[c[:, i], c[:, j]]
        return 1 / (1 + np.exp(-z))


def train(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, sample_rows: int = 20_000) -> AdditiveModel:
    """A model of ``labels.quality`` from the labelled rows that are
    ``learnable`` (a condition on doc_id), at most ``sample_rows``: only ids
    and labels are picked here, their texts become features on the workers."""
    import numpy as np

    python_ready(docs.sparkSession)
    given = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    if learnable is not None:
        given = given.where(learnable)
    given = given.distinct()  # rows that repeat a label are one
    picked = written(given.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows).coalesce(1), "quality-sample")

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            x = feature_matrix(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    # the picked rows are at most sample_rows ids: a bounded broadcast; of
    # documents that share an id one is learned from, combined before the shuffle
    rows = texts(docs).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = rows.mapInArrow(run, "doc_id long, quality int, x array<double>").orderBy("doc_id", "quality", "x").toPandas()
    x = np.array(got["x"].tolist(), dtype=np.float64).reshape(len(got), len(FEATURES))
    return AdditiveModel().fit(x, got["quality"].to_numpy(dtype=np.float64))


def scored(docs: DataFrame, model: AdditiveModel, *more: Column) -> DataFrame:
    """doc_id, ``more`` and score, a row per document."""
    python_ready(docs.sparkSession)
    rows = texts(docs, *more)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            score = model.score(feature_matrix(b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(score)], [*[f.name for f in kept], "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double"
    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """The documents whose text scores at least ``threshold``, unchanged."""
    python_ready(docs.sparkSession)
    if "text" not in docs.columns:
        raise ValueError("documents need a text")
    at = docs.columns.index("text")

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            score = model.score(feature_matrix([t or "" for t in b.column(at).to_pylist()]))
            yield b.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
