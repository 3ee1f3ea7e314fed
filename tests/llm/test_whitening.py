"""Whitening against numpy's eigenvectors and Python integers."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import whiten_cholqr
from tablewright.llm.common import documents
from tablewright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, components=8):
    """Exact integers and the eigenvectors of the covariance."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    a = np.array([[n * p - q for p, q in zip(r, s)] for r in x], dtype=float) / n
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1], v[:, ::-1]
    keep = [k for k in range(min(components, d)) if e[k] > 1e-15 * max(e[0], 1e-300)]
    return deviation, (a @ v[:, keep]) / np.sqrt(e[keep]), e[keep] / e.sum() if keep else []


def held_against_plain(frame, rows, components=8):
    got = {}
    for r in whiten_cholqr.whitened_embeddings(frame, components).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    deviation, white, explained = plain(rows, components)
    assert got.keys() == {i for i, _ in rows}
    for (i, _), d, w in zip(rows, deviation, white):
        assert sorted(got[i]) == list(range(1, len(w) + 1))
        for k, r in got[i].items():
            assert r.n == len(rows) and r.deviation == d == int(r.deviation_exact)
            assert abs(r.explained / explained[k - 1] - 1) < 1e-9 and r.identity_error < 1e-8
    for k in range(white.shape[1]):
        mine = np.array([got[i][k + 1].whitened for i, _ in rows])
        sign = np.sign(mine @ white[:, k])
        assert np.abs(mine - sign * white[:, k]).max() < 1e-6


def test_whitening_of_random_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1 + k) for k in range(11)]) for i in range(120)]
    held_against_plain(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(5), rows)


def test_whitening_of_dependent_and_constant_dimensions(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        a, b = rng.randrange(-900, 900) / 1024, rng.randrange(-90, 90) / 1024
        rows.append((i, [a, b, a + b, 0.5, -a, 7.0]))
    held_against_plain(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), rows)


def test_whitening_of_badly_scaled_rows(spark):
    rng = random.Random(6)
    rows = [(i, [x := rng.gauss(0, 3e5), x + rng.gauss(0, 0.05), rng.gauss(0, 1e-2)]) for i in range(200)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    got = whiten_cholqr.whitened_embeddings(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert len(got) == 600 and max(r.identity_error for r in got) < 1e-4


def test_deviations_beyond_a_long(spark):
    rows = [(i, [1e9 * (-1) ** i, float(i)]) for i in range(5)]
    got = whiten_cholqr.whitened_embeddings(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    want = dict(zip(range(5), plain(rows)[0]))
    assert {r.vec_id: int(r.deviation_exact) for r in got} == want
    assert {r.deviation for r in got} == {None}


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (None, [3.0, 0.0])]
    bad = [(3, None), (4, []), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [-inf, 0.0])]
    frame = spark.createDataFrame([(*r, None) for r in good + bad], SCHEMA)
    for c in ("x", "n", "component", "d", "i", "total", "whitened"):
        frame = frame.withColumn(c, F.lit("clash"))
    got = whiten_cholqr.whitened_embeddings(frame).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2)]
    assert {r.n for r in got} == {4}
    for none in (frame.where("false"), frame.where("vec_id > 2"), frame.where("vec_id = 2"), frame.where("vec_id = 1")):
        assert whiten_cholqr.whitened_embeddings(none).count() == 0
    with pytest.raises(ValueError, match="lengths"):
        whiten_cholqr.whitened_embeddings(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], SCHEMA))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_against_plain(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in documents(spark, SF, "embeddings").collect()]
    got = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    deviation, white, explained = plain(rows)
    at = {i: k for k, (i, _) in enumerate(rows)}
    assert len(got) == 8 * len(rows) and max(r.identity_error for r in got) < 1e-9
    assert all(r.deviation == deviation[at[r.vec_id]] and abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in got)
    assert all(abs(abs(r.whitened) - abs(white[at[r.vec_id]][r.component - 1])) < 1e-6 for r in got)
