"""The divergence audit against plain counts."""

import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import divergence_trees
from tablewright.llm.divergence_trees import Forest, divergence_audit, pair_values, probability

SCHEMA = "doc_id long, text string, lang string, source string"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, top=200):
    docs = [(lang or "", source or "", WORD.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= 3}
        counts = defaultdict(Counter)
        for _, source, words in mine:
            counts[source].update(w for w in words if w in kept)
        whole = sum(counts.values(), Counter())
        price = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        ps, q = {s: price(c) for s, c in counts.items()}, price(whole)
        for s, p in ps.items():
            pairs = [(sum((p[t] - o[t]) ** 2 // o[t] for t in kept), x) for x, o in ps.items() if x != s]
            terms = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)}
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "naïve", "Ärger", "ärger", "x1y", "中文", "a-b", "été", "🙂"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(n):
        k = int(rng.paretovariate(0.8)) + 3
        source = rng.choice(["hot"] * 6 + ["b", "c", None, "", "é", "z"])
        rows.append((i, " ".join(words[min(int(rng.expovariate(0.02)), len(words) - 1)] for _ in range(min(k, 400))), rng.choice(["en", "en", "de", None]), source))
    rows += [(n, "lonely words", "xx", "one"), (n + 1, "", "xx", "two"), (n + 2, None, "yy", "s"), (None, "the the the", "en", "never else"), (3, "same row", "en", "b"), (3, "same row", "en", "b")]
    return rows


def test_audit_against_plain_counts(spark):
    rows = corpus(260, 1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("term", "n", "p", "q", "value", "rank", "block", "chunk", "docs", "part"):
        frame = frame.withColumn(c, F.lit("clash"))
    got = divergence_audit(frame)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = plain(rows)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(want) > 500 and set(found) == want


def test_blocks_and_chunks_agree(spark):
    """Many blocks and source chunks give the sums of one."""
    rows = corpus(200, 2)
    counts = divergence_trees.kept_counts(spark.createDataFrame(rows, SCHEMA))
    totals = divergence_trees.group_totals(counts)
    want = {x for x in plain(rows) if x[2] == "pair"}
    for terms, sources in ((70, 2), (64, 3), (4096, 1)):
        pairs = divergence_trees.source_pairs(counts, totals, terms, sources).select("lang", "source", "part", "item", "value", "rank")
        assert {tuple(r) for r in pairs.collect()} == want


def test_top_terms_only(spark):
    rows = corpus(200, 3)
    got = divergence_audit(spark.createDataFrame(rows, SCHEMA), top=7)
    assert {tuple(r) for r in got.collect()} == plain(rows, 7)


def test_empty_table(spark):
    assert divergence_audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_trees_share_nodes_and_open_pairs_once():
    rng = np.random.default_rng(5)
    counts = rng.poisson(0.05, (6, 1000))
    counts[3] = counts[2]
    forest = Forest(counts)
    assert forest.roots[2] == forest.roots[3]
    # a node per different pair of children, whichever tree or place it is from
    for level in range(1, len(forest.levels)):
        left, right = forest.levels[level]
        assert len(set(zip(left, right))) == len(left)
    assert sum(len(x[0]) for x in forest.levels[1:]) < 1000
    a, b = np.array([0, 2, 4]), np.array([1, 3, 5])
    k, x, y, times = forest.leaf_pairs(a, b)
    assert len(set(zip(k, x, y))) == len(k)
    for i in range(3):
        want = Counter(zip(counts[a[i]].tolist(), counts[b[i]].tolist()))
        got = {(int(p), int(q)): int(t) for j, p, q, t in zip(k, x, y, times) if j == i and p >= 0}
        assert got == want


def test_prices_beyond_64_bits():
    count = np.array([0, 5, 12_000_000_000, 9_100_000_000_000])
    total = np.array([13, 10**10, 10**14, 10**16])
    assert probability(count, total, 7).tolist() == [1 + 10**9 * (int(c) + 1) // (int(t) + 7) for c, t in zip(count, total)]
    forest = Forest(np.array([[9_100_000_000_000, 0, 3], [1, 12_000_000_000, 0]]))
    totals = np.array([9_100_000_000_003, 12_000_000_001])
    ab, ba = pair_values(forest, totals, 3, np.array([0]), np.array([1]))
    p = [[1 + 10**9 * (int(c) + 1) // (int(t) + 3) for c in row] for row, t in zip([[9_100_000_000_000, 0, 3], [1, 12_000_000_000, 0]], totals)]
    assert ab[0] == sum((x - y) ** 2 // y for x, y in zip(*p)) and ba[0] == sum((x - y) ** 2 // x for x, y in zip(*p))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables not present")
def test_query_against_plain_counts(spark):
    from tablewright.llm.common import documents
    from tablewright.llm.queries import QUERIES

    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents(spark, "/root/testdata/sf0.001").collect()]
    assert {tuple(r) for r in QUERIES["op11_divergence_audit"](spark, "/root/testdata/sf0.001").collect()} == plain(rows)
