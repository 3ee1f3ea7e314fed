"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and benchmark items are normalised alike: lower case, every run of
other than letters and digits one blank. A region is ``region`` characters of
an item (a shorter item is one region). A text that holds a region within k
edits shares at least ``m + 1 - q (k + 1)`` of its q-grams on diagonals (text
place minus item place) that lie at most k apart. So each task looks up the
q-grams of its texts in the benchmark's index, counts them per item in
overlapping bands of diagonals, keeps bands that reach that number, and
aligns inside the band the regions at every place of the item that reach it
by themselves. Documents stay where they are; nothing is shuffled but the few
matches.

The benchmark's different texts are read in blocks of at most about
``block_chars`` characters, chosen by hash: each block's index is a broadcast
of bounded size, and at most ``BLOCKS_AT_ONCE`` of them are held; a larger
benchmark takes more passes over the documents.

Nulls and edges: null or empty texts and items match nothing; items of fewer
than ``MIN_CHARS`` normalised characters hold no q-gram and are not searched;
items of fewer than ``SHORT_ITEM`` must stand in a text exactly, at word
edges; a repeated document or item gives a row for each pair; other columns
are not read; an empty table on either side gives no match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, texts, written

Q = 10
ERROR_RATE = 0.08
REGION = 100
#: Items of fewer normalised characters hold no q-gram and are not searched;
#: shorter ones than SHORT_ITEM must stand in a text exactly, at word edges.
MIN_CHARS = Q
SHORT_ITEM = 40
BLOCK_CHARS = 1 << 20
#: Code units of text, and index hits, that are handled at a time.
TEXT_BLOCK = 1 << 21
HIT_BLOCK = 1 << 20
#: Characters of the grams that a region must share before it is aligned.
SHORT_Q = 5
#: Region starts of an item that are aligned at a time.
START_BLOCK = 1 << 12
#: Blocks of the benchmark whose indexes are held at a time.
BLOCKS_AT_ONCE = 8
SCHEMA = "doc_id long, item long, edits int, region_chars int, text_place long"


@lru_cache(maxsize=1)
def _unit_codes():
    """UTF-16 code unit -> 0 for the separator, 32 for other than letters and
    digits, else one byte (ASCII and Latin-1 as they are)."""
    import numpy as np

    units = np.arange(1 << 16, dtype=np.uint32)
    kept = np.array([0xD800 <= c < 0xE000 or chr(c).isalnum() for c in range(1 << 16)])
    folded = np.where(units < 256, units, 128 + (units * np.uint32(0x9E3779B1) >> np.uint32(25)))
    codes = np.where(kept, folded, 32).astype(np.uint8)
    codes[0] = 0
    return codes


def normalised(batch: list[str]):
    """The texts as one array of codes, each closed by a 0."""
    import numpy as np

    joined = "\0".join(t.replace("\0", " ") if "\0" in t else t for t in batch) + "\0"
    codes = _unit_codes()[np.frombuffer(joined.lower().encode("utf-16-le", "surrogatepass"), dtype=np.uint16)]
    blank = codes == 32
    drop = blank.copy()
    drop[1:] &= blank[:-1] | (codes[:-1] == 0)
    return codes[~drop]


def gram_hashes(codes):
    """A 64-bit hash of the Q codes that start at every place."""
    import numpy as np

    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    whole = np.ascontiguousarray(codes)
    head = np.ndarray((n,), dtype="<u8", buffer=whole, strides=(1,))
    tail = np.ndarray((n,), dtype="<u8", buffer=whole, offset=Q - 8, strides=(1,))
    h = head * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += tail * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def edit_budget(m: int) -> int:
    """Edits allowed in a region of m characters: the error rate, as far as
    the lemma leaves a q-gram to find."""
    return max(0, min(int(ERROR_RATE * m), m // Q - 1))


def needed_hits(m: int) -> int:
    return m + 1 - Q * (edit_budget(m) + 1)


class BenchmarkIndex:
    """The q-grams of one block of items."""

    FILTER_BITS = 22

    def __init__(self, items: list[tuple]):
        import numpy as np

        self.ids, self.codes = [], []
        for item_id, text in items:
            codes = normalised([text or ""])[:-1]
            codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
            if len(codes) >= MIN_CHARS:
                self.ids.append(item_id)
                self.codes.append(codes)
        grams = [gram_hashes(c) for c in self.codes]
        self.grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.item = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])
        self.place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams]) if grams else np.zeros(0, np.int32)
        order = np.argsort(self.grams, kind="stable")
        self.grams, self.item, self.place = self.grams[order], self.item[order], self.place[order]
        self.maybe = np.zeros(1 << self.FILTER_BITS, dtype=bool)
        self.maybe[self.grams >> np.uint64(64 - self.FILTER_BITS)] = True
        sizes = [min(REGION, len(c)) for c in self.codes]
        self.needed = np.array([needed_hits(m) for m in sizes], dtype=np.int64)
        self.width = np.array([edit_budget(m) + 1 for m in sizes], dtype=np.int64)

    def hits(self, codes):
        """(text place, item, item place) of every shared q-gram, in chunks."""
        import numpy as np

        for at in range(0, max(1, len(codes) - Q + 1), TEXT_BLOCK):
            h = gram_hashes(codes[at : at + TEXT_BLOCK + Q - 1])
            found = np.flatnonzero(self.maybe[h >> np.uint64(64 - self.FILTER_BITS)])
            lo = np.searchsorted(self.grams, h[found], side="left")
            n = np.searchsorted(self.grams, h[found], side="right") - lo
            found, lo, n = found[n > 0], lo[n > 0], n[n > 0]
            ends = np.cumsum(n)
            start = 0
            while start < len(found):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HIT_BLOCK)))
                part = n[start:stop]
                first = np.repeat(lo[start:stop], part)
                nth = np.arange(len(first)) - np.repeat(np.cumsum(part) - part, part)
                yield at + np.repeat(found[start:stop], part), self.item[first + nth], self.place[first + nth]
                start = stop

    def bands(self, codes):
        """(text, item, lowest diagonal, highest diagonal) of bands with
        enough shared q-grams; diagonals count from the text's start. A band
        is two widths of diagonals, and bands overlap by one width, so
        diagonals at most k apart meet in a band."""
        import numpy as np

        ends = np.flatnonzero(codes == 0)
        starts = np.concatenate([[0], ends[:-1] + 1])
        span, middle, n_items = np.int64(1) << np.int64(31), np.int64(1) << np.int64(30), np.int64(max(1, len(self.ids)))
        kept_keys, kept_n = [], []
        for text_at, item, item_at in self.hits(codes):
            text = np.searchsorted(ends, text_at)
            band = (text_at - starts[text] - item_at) // self.width[item] + middle
            key = (text * n_items + item) * span + band
            keys, n = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            kept_keys.append(keys)
            kept_n.append(n)
        if not kept_keys:
            return []
        keys, where = np.unique(np.concatenate(kept_keys), return_inverse=True)
        n = np.bincount(where, np.concatenate(kept_n))
        text, item = np.divmod(keys // span, n_items)
        good = n >= self.needed[item]
        text, item = text[good], item[good]
        low = (keys[good] % span - middle) * self.width[item]
        return list(zip(text.tolist(), item.tolist(), low.tolist(), (low + 2 * self.width[item] - 1).tolist()))

    def verified(self, codes, item: int, low: int, high: int):
        """(edits, region size, text place) of the item's best region inside
        a band, or None. Every region start is tried."""
        import numpy as np

        whole, best = self.codes[item], None
        m = min(REGION, len(whole))
        k = edit_budget(m)
        for s in range(0, len(whole) - m + 1, START_BLOCK):
            part = whole[s : s + START_BLOCK + m - 1]
            # the text along the part on diagonals low - k to high + k; 0 beyond its ends
            a, b = s + low - k, s + len(part) + high + k
            if a >= len(codes) or b <= 0:
                continue
            text = np.zeros(b - a, dtype=np.uint8)
            text[max(0, -a) : min(b, len(codes)) - a] = codes[max(0, a) : max(0, b)]
            got = best_region(part, text, m, k)
            if got and (best is None or got[0] < best[0]):
                best = (got[0], m, max(0, a + got[1]))
                if got[0] == 0:
                    break
        return best


def _sums(x, n: int):
    """The sums of n neighbours along the last axis."""
    import numpy as np

    ends = np.cumsum(x, axis=-1, dtype=np.int32)
    ends[..., n:] -= ends[..., :-n].copy()
    return ends[..., n - 1 :]


def best_region(part, text, m: int, k: int) -> tuple[int, int] | None:
    """(edits, place in ``text``) of the region of m characters of ``part``
    that lies nearest to ``text`` on its diagonals, or None if none has at
    most k edits. Only starts whose region has the shared q-grams that the
    lemma demands, of Q and of SHORT_Q characters, are aligned, all of them at
    once, and each as long as it has at most k edits."""
    import numpy as np

    n_diagonals = len(text) - len(part) + 1
    differs = np.lib.stride_tricks.sliding_window_view(text, len(part)) != part  # diagonal, place in part
    if differs.shape[1] < m:
        return None
    exact = _sums(differs, m) == 0
    if exact.any():
        start = int(np.argmax(exact.any(axis=0)))
        return 0, start + int(np.argmax(exact[:, start]))
    shared = (_sums(differs[k : n_diagonals - k], Q) == 0).sum(axis=0)
    enough = _sums(shared, m - Q + 1) >= needed_hits(m)
    if not enough.any():
        return None
    held = (_sums(differs, SHORT_Q) == 0).any(axis=0)
    enough &= _sums(held, m - SHORT_Q + 1) >= m + 1 - SHORT_Q * (k + 1)
    starts = np.flatnonzero(enough)
    steps = np.arange(n_diagonals, dtype=np.int16)[:, None]
    row = np.zeros((n_diagonals, len(starts)), dtype=np.int16)  # a match may begin on any diagonal
    for i in range(m):
        if i % 8 == 0:  # the least of a column never falls
            alive = row.min(axis=0) <= k
            if not alive.all():
                row, starts = row[:, alive], starts[alive]
            if not len(starts):
                return None
        new = row + differs[:, starts + i]
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        row = np.minimum.accumulate(new - steps, axis=0) + steps
    edits = row.min(axis=0)
    at = int(np.argmin(edits))
    return (int(edits[at]), int(starts[at]) + int(np.argmin(row[:, at]))) if edits[at] <= k else None


def whole_words(text, item) -> tuple | None:
    """(0, size, place) of the first place where the item stands in the text
    between words."""
    place = (b" " + text.tobytes() + b" ").find(b" " + item.tobytes() + b" ")
    return (0, len(item), place) if place >= 0 else None


def find_regions(index: BenchmarkIndex, batch: list[str]) -> list[tuple]:
    """(row in batch, item id, edits, region size, normalised text place), at
    most one for a text and item."""
    import numpy as np

    codes = normalised(batch)
    ends = np.flatnonzero(codes == 0)
    best: dict[tuple, tuple] = {}
    for row, item, low, high in index.bands(codes):
        text = codes[int(ends[row - 1]) + 1 if row else 0 : int(ends[row])]
        if len(index.codes[item]) < SHORT_ITEM:
            if (row, item) not in best and (got := whole_words(text, index.codes[item])):
                best[(row, item)] = got
            continue
        got = index.verified(text, item, low, high)
        if got and got < best.get((row, item), (1 << 30,)):
            best[(row, item)] = got
    return [(row, index.ids[item], *got) for (row, item), got in sorted(best.items())]


def distinct_items(benchmark: DataFrame) -> DataFrame:
    """(item, text): each text once, named by its hash."""
    return benchmark.where("text IS NOT NULL").select(F.xxhash64("text").alias("item"), "text").dropDuplicates(["item", "text"])


def indexed(items: DataFrame, block_chars: int) -> Iterator:
    """Broadcast indexes of ``items``, of about ``block_chars`` characters
    each; a block is read, and its index built, when it is asked for."""
    spark = items.sparkSession
    items = written(items, "benchmark-items")
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(chars / block_chars))
    for block in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        yield spark.sparkContext.broadcast(BenchmarkIndex(sorted((r[0], r[1]) for r in mine.collect())))


def contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, edits, region_chars and text_place (in the normalised
    text) for every document that holds a region of an item. Items of one
    text are searched once."""
    python_ready(docs.sparkSession)
    rows = texts(docs)
    parts, held = [], []
    for index in indexed(distinct_items(benchmark), block_chars):

        def run(batches, index=index) -> Iterator:
            import pyarrow as pa

            for b in batches:
                ids = b.column(0).to_pylist()
                found = [(ids[r[0]], *r[1:]) for r in find_regions(index.value, b.column(1).to_pylist())]
                cols = list(zip(*found)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item", "edits", "region_chars", "text_place"])

        parts.append(rows.mapInArrow(run, SCHEMA))
        held.append(index)
        if len(held) == BLOCKS_AT_ONCE:  # no more indexes than these at a time
            done = written(reduce(DataFrame.unionByName, parts), "contaminated")
            parts, held = [done], _dropped(held)
    ids = benchmark.where("text IS NOT NULL").select(F.xxhash64("text").alias("item"), F.col("item_id").cast("long").alias("item_id"))
    found = reduce(DataFrame.unionByName, parts)
    return found.join(ids, "item").select("doc_id", "item_id", "edits", "region_chars", "text_place")


def _dropped(held: list) -> list:
    for index in held:
        index.destroy()
    return []


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows whose text holds a region of the benchmark.
    Each row is judged by its own text, where it lies: ids play no part."""
    python_ready(docs.sparkSession)
    at, kept, held = docs.columns.index("text"), docs, []
    for index in indexed(distinct_items(benchmark), block_chars):

        def run(batches, index=index) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for b in batches:
                clean = np.ones(len(b), dtype=bool)
                clean[[r[0] for r in find_regions(index.value, [t or "" for t in b.column(at).to_pylist()])]] = False
                yield b.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
        held.append(index)
        if len(held) == BLOCKS_AT_ONCE:
            kept = written(kept, "uncontaminated")
            held = _dropped(held)
    return kept
