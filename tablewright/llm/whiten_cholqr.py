"""Whitening of embeddings by shifted CholeskyQR.

Entries become integers, ``floor(1024 c) + 100000``; the row count and the
sums per dimension are exact. Each pass is one Spark job that adds up Gram
matrices: a task keeps one d x d matrix, its entries are summed per (i, j) in
a shuffle, and the driver receives the d * (d + 1) / 2 sums. Factors are
Cholesky factors of these sums, the first one shifted so that it exists for
rows of any condition; every later pass sees the centred rows after a
triangular solve per factor. Passes end when the rows are orthonormal to
working precision. The product of the factors is R, and the singular values
and right vectors of R are those of the centred rows: the components.

Directions without any variance stay zero through all passes; they are told
by a Gram eigenvalue near 0 where all others are 1, and no component is
returned for them (equal rows alone, or a single row, give no component).

Nulls and edges: a null or empty vector, and one with a null or non-finite
entry, is dropped; a null ``vec_id`` and repeated rows are kept, a row each;
vectors of different lengths stop with an error, and so do entries of 2**30
and more, whose integers would leave the exact range; an empty table gives an
empty result; other columns are not read. ``deviation`` is null where the
exact value, which ``deviation_exact`` then still holds, exceeds a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, written

SCALE = 1024
OFFSET = 100_000
#: Entries c below this keep integers below 2**41.
MAX_ENTRY = float(1 << 30)
MAX_PASSES = 8
#: Orthonormal: eigenvalues of the Gram matrix this near to 1.
NEAR_ONE = 1e-12
#: An eigenvalue below this after the first solve is a direction without
#: variance: its share of all is below double precision.
NO_VARIANCE = 1e-8
#: Components whose singular value is below this share of the largest cannot
#: be told from rounding.
MIN_SHARE = 1e-11


def integer_rows(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows of the fit list as integers."""
    v = F.transform(vector, lambda c: c.cast("double"))
    fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.where((F.size(vector) > 0) & fits)
    whole = F.transform(v, lambda c: F.when(F.abs(c) < MAX_ENTRY, F.floor(c * SCALE) + OFFSET).otherwise(F.raise_error(F.lit("an entry of 2**30 or more"))))
    return rows.select(F.col(vec_id).alias("vec_id"), whole.alias("x"))


def matrix(column):
    """An Arrow list column without nulls as a matrix of 64-bit integers."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


@dataclass
class Centre:
    """Exact mean of ``n`` integer rows: ``base + rest / n`` per dimension."""

    n: int
    base: list[int]
    rest: list[int]

    def rows(self, x):
        import numpy as np

        return (x - np.array(self.base)) - np.array(self.rest, dtype=float) / self.n

    def deviations(self, x) -> list[int]:
        """Sum over dimensions of (n x - S)^2 of every row, exact: with
        u = x - base it is n^2 sum(u^2) - 2 n sum(u r) + sum(r^2)."""
        import numpy as np

        u, r = x - np.array(self.base), np.array(self.rest)
        top = int(np.abs(u).max(initial=0)) * len(self.base)
        if top * max(top, self.n) >= 1 << 62:
            u, r = u.astype(object), r.astype(object)
        n, constant = self.n, sum(k * k for k in self.rest)
        return [n * n * int(a) - 2 * n * int(b) + constant for a, b in zip((u * u).sum(axis=1), u.dot(r))]


def centre(rows: DataFrame) -> Centre | None:
    """Row count and sums per dimension, added up per task, then per place."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums: dict[int, list] = {}  # by vector length: places and rows
        for b in batches:
            lengths = b.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                x = matrix(b.column(0).filter(pa.array(lengths == d)))
                held = sums.setdefault(int(d), [[0] * int(d), 0])
                held[0] = [a + int(s) for a, s in zip(held[0], x.sum(axis=0))]
                held[1] += len(x)
        for d, (total, n) in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"d": [d] * d, "place": list(range(d)), "n": [n] * d, "total": total},
                pa.schema([("d", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))]),
            )

    parts = rows.select("x").mapInArrow(run, "d int, place int, n long, total decimal(38,0)")
    sums = parts.groupBy("d", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("d", "place").collect()
    if len({r["d"] for r in sums}) > 1:
        raise ValueError(f"vectors of lengths {sorted({r['d'] for r in sums})}")
    if not sums:
        return None
    n = sums[0]["n"]
    return Centre(n, [int(r["total"]) // n for r in sums], [int(r["total"]) % n for r in sums])


def triangular_solve(a, r):
    """a times the inverse of the upper triangular r, column by column."""
    import numpy as np

    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def gram(rows: DataFrame, mean: Centre, factors: list, project=None):
    """Gram matrix of the centred rows after a solve per factor, or of their
    projection with a last column of ones: one job over all rows."""
    import numpy as np

    def run(batches) -> Iterator:
        import pyarrow as pa

        total = None
        for b in batches:
            a = mean.rows(matrix(b.column(0)))
            for r in factors:
                a = triangular_solve(a, r)
            if project is not None:
                a = np.hstack([a @ project, np.ones((len(a), 1))])
            total = a.T @ a if total is None else total + a.T @ a
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "g"])

    parts = rows.select("x").mapInArrow(run, "i int, j int, g double")
    size = len(mean.base) if project is None else project.shape[1] + 1
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["g"]
    return out


@dataclass
class Whitening:
    """Mean, components (columns), their eigenvalues and the trace."""

    mean: Centre
    components: object
    values: object
    trace: float
    factors: list = field(default_factory=list)

    @property
    def projection(self):
        import numpy as np

        return self.components / np.sqrt(self.values)


def cholesky_qr(rows: DataFrame, mean: Centre) -> tuple[list, object]:
    """The factors R1, R2, ... and the Gram matrix of the rows after them."""
    import numpy as np

    d, factors = len(mean.base), []
    g = gram(rows, mean, factors)
    if not g.any():
        return factors, g
    u = np.finfo(float).eps / 2
    shift = 11 * (mean.n * d + d * (d + 1)) * u * np.linalg.norm(g, 2)
    factors.append(np.linalg.cholesky(g + shift * np.eye(d)).T)
    for _ in range(MAX_PASSES):
        g = gram(rows, mean, factors)
        values, vectors = np.linalg.eigh(g)
        none = values < NO_VARIANCE
        if np.abs(values[~none] - 1).max(initial=0) <= NEAR_ONE:
            break
        # directions without variance are given a one, so that the factor exists
        factors.append(np.linalg.cholesky(g + vectors[:, none] @ vectors[:, none].T).T)
    return factors, g


def fit(rows: DataFrame, components: int) -> Whitening | None:
    """The whitening of all ``rows`` (of ``integer_rows``); None without rows."""
    import numpy as np

    python_ready(rows.sparkSession)
    mean = centre(rows)
    if mean is None:
        return None
    factors, g = cholesky_qr(rows, mean)
    values, vectors = np.linalg.eigh(g)  # ones, and zeros where nothing varies
    r = (vectors * np.sqrt(values.clip(0))) @ vectors.T
    for factor in reversed(factors):
        r = r @ factor
    _, s, vt = np.linalg.svd(r)
    keep = [k for k in range(min(components, len(s))) if s[k] > MIN_SHARE * s[0]]
    v = vt[keep].T
    if keep:  # the sign with which a component's largest entry is positive
        v = v * np.sign(v[np.abs(v).argmax(axis=0), range(len(keep))])
    return Whitening(mean, v, s[keep] ** 2 / mean.n, float((s**2).sum() / mean.n), factors)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity,
    measured over all rows."""
    import numpy as np

    k = model.components.shape[1]
    g = gram(rows, model.mean, [], model.projection) / model.mean.n
    return float(np.abs(g[:k, :k] - np.outer(g[:k, k], g[:k, k]) - np.eye(k)).max(initial=0.0))


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def whitened(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """A row per row and component."""
    mean, projection = model.mean, model.projection
    explained = (model.values / model.trace).tolist()

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        k = len(explained)
        for b in batches:
            x = matrix(b.column(1))
            exact = mean.deviations(x)
            put = np.repeat(np.arange(len(x)), k)
            longs = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(put)),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(put), mean.n)),
                    longs.take(pa.array(put)),
                    pa.array((mean.rows(x) @ projection).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(put), error)),
                    pa.array(exact, pa.decimal128(38, 0)).take(pa.array(put)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
            )

    vec_id = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {vec_id}, {SCHEMA}")


def whitened_embeddings(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """Every usable row on the first ``components`` components. The integer
    rows are written once, so all passes read the same rows."""
    rows = written(integer_rows(embeddings), "embedding-integers")
    model = fit(rows, components)
    if model is None or not len(model.values):
        vec_id = rows.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id {vec_id}, {SCHEMA}")
    return whitened(rows, model, identity_error(rows, model))
