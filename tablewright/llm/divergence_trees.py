"""Source divergence audit with hash-consed segment trees over term counts.

Terms are counted per (lang, source) in one pass: tasks add up counts of their
documents, so a hot word costs a row per task and source, and one shuffle by
(lang, term) completes counts and document numbers. Kept terms of a language
are dealt over blocks by a hash. In a block the terms, most frequent first,
are the leaves of a segment tree per source; equal counts share a leaf, and
nodes with the same children share a node, whichever source or place they
belong to. Two trees are walked together from the root: a pair of nodes that
is met again only adds to its multiplicity, so each pair is opened and each
pair of counts priced once. Spark adds the blocks' sums, the trees' top.

A block holds at most about 2**20 counts; blocks of a language with many
sources hold fewer terms, and its source pairs are dealt over further tasks,
so no task sees a whole language or a whole source. Prices are exact: integer
arithmetic throughout, beyond 64 bits where counts require it.

Nulls and edges: null text, lang and source are read as ''; rows that repeat
are documents of their own; a language without kept terms prices every pair
of its sources at 0 and has no term rows; a lone source has no pair row; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import python_ready, written

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
SMOOTH = 1
MIN_DOCS = 3
TOP_TERMS = 200
#: Bytes of text whose terms a task adds up at a time.
CHUNK_BYTES = 12 << 20
#: Terms of a block, and counts of a block over all its sources.
BLOCK_TERMS = 4096
BLOCK_COUNTS = 1 << 20
#: Sources whose pairs one task prices.
CHUNK_SOURCES = 64
#: Node pairs that are open at a time.
OPEN_PAIRS = 1 << 20


def term_table():
    """Byte table of term characters: A-Z become a-z, other letters and bytes
    of non-ASCII characters stay, all else becomes a blank."""
    import numpy as np

    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for c in range(ord("a"), ord("z") + 1):
        table[c] = table[c - 32] = c
    return table


def chunk_counts(texts, groups, table):
    """(group, term, n, docs) of some documents: ``texts`` an Arrow binary
    array, ``groups`` the group number of each."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    offsets, data = texts.buffers()[1:]
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    clean = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer((at - at[0]).astype(np.int32)), pa.py_buffer(table[raw])])
    words = pc.ascii_split_whitespace(clean)
    doc = np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    code, terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    blank = terms.index("").as_py()
    if blank >= 0:
        doc, code = doc[code != blank], code[code != blank]
    n_terms = max(len(terms), 1)
    pair, n = np.unique(doc * n_terms + code, return_counts=True)  # a document's terms
    key = groups[pair // n_terms] * n_terms + pair % n_terms
    found, slot, docs = np.unique(key, return_inverse=True, return_counts=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, slot, n)
    return found // n_terms, terms.take(pa.array(found % n_terms)), total, docs


def partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) added up per task, and a row with a null
    term for each group a task has met."""
    python_ready(docs.sparkSession)
    empty = F.lit("")
    read = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce("text", empty).cast("binary").alias("text"))

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table, seen = term_table(), {}
        held, numbers, size = [], [], 0

        def rows(keys, terms, n, n_docs):
            langs, sources = (pa.array([k[i] for k in seen], pa.string()).take(pa.array(keys)) for i in (0, 1))
            return pa.RecordBatch.from_arrays([langs, sources, terms, pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

        for b in batches:
            for lang, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                numbers.append(seen.setdefault((lang, source), len(seen)))
            held.append(b.column(2))
            size += b.column(2).nbytes
            if size >= CHUNK_BYTES:
                yield rows(*chunk_counts(pa.concat_arrays(held), np.array(numbers), table))
                held, numbers, size = [], [], 0
        if held:
            yield rows(*chunk_counts(pa.concat_arrays(held), np.array(numbers), table))
        if seen:
            zeros = np.zeros(len(seen), dtype=np.int64)
            yield rows(np.arange(len(seen)), pa.nulls(len(seen), pa.string()), zeros, zeros)

    return read.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, total, first): counts of kept terms, with the
    language's count and a mark on one row per term; and a row with a null
    term per group."""
    counts = partial_counts(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    one = Window.partitionBy("lang", "term").orderBy("source")
    whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = counts.select("lang", "source", "term", "n", F.sum("docs").over(whole).alias("df"), F.sum("n").over(whole).alias("total"), (F.row_number().over(one) == 1).alias("first"))
    return written(marked.where((F.col("df") >= min_docs) | F.col("term").isNull()).drop("df"), "term-counts")


def group_totals(counts: DataFrame) -> DataFrame:
    """(lang, source, group_n, lang_n, v, sources), a row per group."""
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.sum(F.when(F.col("term").isNotNull() & F.col("first"), 1).otherwise(0)).alias("firsts"))
    langs = groups.groupBy("lang").agg(F.sum("group_n").alias("lang_n"), F.sum("firsts").alias("v"), F.count("*").alias("sources"))
    return written(groups.drop("firsts").join(langs, "lang"), "group-totals")


def _p(count: str, total: str) -> str:
    return f"1L + (CAST({SCALE} AS DECIMAL(20, 0)) * CAST({count} + {SMOOTH} AS DECIMAL(18, 0))) div CAST({total} + {SMOOTH} * v AS DECIMAL(38, 0))"


def top_terms(counts: DataFrame, totals: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """Terms that a group has more of than its language, by value."""
    priced = counts.where("term IS NOT NULL AND n > 0").join(totals, ["lang", "source"]).selectExpr("lang", "source", "term", f"{_p('n', 'group_n')} AS p", f"{_p('total', 'lang_n')} AS q")
    valued = priced.where("p > q").selectExpr("lang", "source", "'term' AS part", "term AS item", "((p - q) * (p - q)) div q AS value")
    return _ranked(valued).where(F.col("rank") <= top)


def _ranked(valued: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order))


class Forest:
    """Segment trees over the rows of a matrix of counts, one per row, with
    shared nodes. ``levels[0]`` holds each leaf's count (-1: no term); a node
    of a higher level is its pair of children on the level below."""

    def __init__(self, counts):
        import numpy as np

        width = 1
        while width < counts.shape[1]:
            width *= 2
        padded = np.full((counts.shape[0], width), -1, dtype=np.int64)
        padded[:, : counts.shape[1]] = counts
        leaves, ids = np.unique(padded, return_inverse=True)
        ids = ids.reshape(padded.shape)
        self.levels, size = [leaves], len(leaves)
        while ids.shape[1] > 1:
            nodes, merged = np.unique(ids[:, ::2] * size + ids[:, 1::2], return_inverse=True)
            self.levels.append((nodes // size, nodes % size))
            ids, size = merged.reshape(ids.shape[0], -1), len(nodes)
        self.roots = ids[:, 0]

    def leaf_pairs(self, a, b):
        """(k, count of a[k]'s tree, count of b[k]'s tree, multiplicity) of
        the leaves under the k-th pair of trees, walked together."""
        import numpy as np

        k, x, y, times = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), dtype=np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            left, right = self.levels[level]
            below = self.levels[level - 1]
            size = len(below) if level == 1 else len(below[0])
            key = np.concatenate([(k * size + side[x]) * size + side[y] for side in (left, right)])
            met, slot = np.unique(key, return_inverse=True)
            total = np.zeros(len(met), dtype=np.int64)
            np.add.at(total, slot, np.concatenate([times, times]))
            k, x, y, times = met // size // size, met // size % size, met % size, total
        return k, self.levels[0][x], self.levels[0][y], times


def probability(count, total, v):
    """p of counts in groups of ``total`` terms (arrays), exact."""
    import numpy as np

    if len(count) and int(count.max()) >= 9_000_000_000:
        count, total = count.astype(object), total.astype(object)
    return np.array(1 + (SCALE * (count + SMOOTH)) // (total + SMOOTH * v), dtype=np.int64)


def pair_values(forest: Forest, totals, v: int, a, b):
    """Sum of (p - q)^2 div q over the terms for the pairs (a, b) and (b, a):
    p of the first, q of the second."""
    import numpy as np

    ab, ba = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
    step = max(1, OPEN_PAIRS >> (len(forest.levels) - 1))
    for at in range(0, len(a), step):
        k, x, y, times = forest.leaf_pairs(a[at : at + step], b[at : at + step])
        real = x >= 0
        k, x, y, times = k[real] + at, x[real], y[real], times[real]
        p, q = probability(x, totals[a[k]], v), probability(y, totals[b[k]], v)
        square = (p - q) * (p - q)
        np.add.at(ab, k, times * (square // q))
        np.add.at(ba, k, times * (square // p))
    return ab, ba


def block_values(table):
    """Values of the source pairs of one task from the counts of its block.
    A pair belongs to the chunk of its first source, both ways."""
    import numpy as np
    import pyarrow as pa

    here = table.filter(pa.compute.is_null(table["term"])).sort_by("source")
    sources, totals = here["source"].to_pylist(), here["group_n"].to_numpy().astype(np.int64)
    rows = table.filter(pa.compute.is_valid(table["term"])).sort_by([("total", "descending"), ("term", "ascending")])
    coded = rows["term"].combine_chunks().dictionary_encode()
    place = {s: i for i, s in enumerate(sources)}
    counts = np.zeros((len(sources), max(len(coded.dictionary), 1)), dtype=np.int64)
    if len(rows):
        counts[[place[s] for s in rows["source"].to_pylist()], coded.indices.to_numpy(zero_copy_only=False)] = rows["n"].to_numpy()
    else:
        counts[:] = -1
    mine = np.flatnonzero(here["own_chunk"].to_numpy(zero_copy_only=False) == table["chunk"][0].as_py())
    a = np.repeat(mine, len(sources) - 1 - mine)
    b = np.concatenate([np.arange(i + 1, len(sources)) for i in mine] or [a])
    ab, ba = pair_values(Forest(counts), totals, int(here["v"][0].as_py()), a, b)
    names = pa.array(sources, pa.string())
    lang = pa.array([table["lang"][0].as_py()] * 2 * len(a), pa.string())
    first, second = names.take(pa.array(np.concatenate([a, b]))), names.take(pa.array(np.concatenate([b, a])))
    return pa.table({"lang": lang, "source": first, "item": second, "value": pa.array(np.concatenate([ab, ba]))})


def source_pairs(counts: DataFrame, totals: DataFrame, block_terms: int = BLOCK_TERMS, chunk_sources: int = CHUNK_SOURCES) -> DataFrame:
    """Every ordered pair of a language's sources, by value."""
    terms = F.least(F.lit(block_terms).cast("long"), F.greatest(F.lit(64).cast("long"), F.expr(f"{BLOCK_COUNTS} div sources")))
    shape = totals.select(
        "*",
        F.greatest(F.lit(1), F.ceil(F.col("v") / terms)).cast("int").alias("blocks"),
        F.ceil(F.col("sources") / chunk_sources).cast("int").alias("chunks"),
    ).withColumn("own_chunk", F.expr("CAST(pmod(xxhash64(source), chunks) AS INT)"))
    chunk = F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk")
    cells = counts.where("term IS NOT NULL AND n > 0").join(shape, ["lang", "source"])
    cells = cells.select("lang", F.expr("CAST(pmod(xxhash64(term, 7L), blocks) AS INT)").alias("block"), "source", "term", "n", "total", "group_n", "v", "own_chunk", "chunks")
    groups = shape.select("lang", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"), "group_n", "v", "own_chunk", "chunks")
    dealt = cells.unionByName(groups).select("*", chunk).drop("chunks")
    sums = dealt.groupBy("lang", "block", "chunk").applyInArrow(block_values, "lang string, source string, item string, value long")
    return _ranked(sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair")))


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a
    language and the terms in which a source stands out from its language."""
    counts = kept_counts(docs, min_docs)
    totals = group_totals(counts)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return source_pairs(counts, totals).select(columns).unionByName(top_terms(counts, totals, top).select(columns))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS w
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL),
v AS (SELECT l.lang, count(k.term) AS v, coalesce(sum(k.total), 0) AS lang_n FROM (SELECT DISTINCT lang FROM g) l LEFT JOIN k ON l.lang = k.lang GROUP BY l.lang),
t AS (
  SELECT g.lang, g.source, v.v, v.lang_n, coalesce(sum(c.n), 0) AS group_n
  FROM g JOIN v ON g.lang = v.lang LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
dense AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + {SMOOTH})) // (t.group_n + {SMOOTH} * t.v) AS p,
         1 + (CAST({SCALE} AS HUGEINT) * (k.total + {SMOOTH})) // (t.lang_n + {SMOOTH} * t.v) AS q
  FROM t JOIN k ON t.lang = k.lang LEFT JOIN c ON t.lang = c.lang AND t.source = c.source AND k.term = c.term),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM dense WHERE n > 0 AND p > q),
z AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM e)
SELECT * FROM z WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
