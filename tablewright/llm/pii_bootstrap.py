"""Personal data by bootstrapped contextual extraction.

Base entities (emails, addresses, cards, phones) are found in every whole
text and seed the bootstrap. Each seed and each other identifier-like token
(four or more characters, two or more digits) lies in a lexical pattern, the
two words before it. Patterns and instances form a graph. Spark scores it in
rounds: a pattern's confidence is the scored share of all that follows it in
the corpus, an instance's score the noisy-or of its patterns. Identifiers in
patterns of high confidence, base entities or not, are the result.

What follows a pattern (a word, a token inside a word as in "card #4111", an
identifier) is counted over all texts for patterns that have enough
instances, with the pattern cut as before an identifier; a fixed-size bit table picks candidates on the workers, and
a join makes the choice exact. Edges and scores stay in Spark tables.

Nulls and edges: a null text is empty (no spans); rows that repeat are each
returned; a null id is kept; other columns are not read; without seeds no
pattern gains confidence and the base spans are the result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, texts, written

#: Kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone", "id")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ZONE = re.compile(r"[0-9][0-9\x20.-]*")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
TOKEN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.@/+-")
#: Words of a context: up to white space, or with the sign that ends a label.
CONTEXT_WORD = re.compile(r"[^\s:=]*[:=]|[^\s:=]+")
TRIM = "\"'`()[]{}<>,;.!?*"
#: Signs before a token that do not belong to it, and the starts of tokens
#: inside a word: after such signs at its start, or after a sign of no token.
LEAD = "._@/+-"
INNER = re.compile(r"(?:^[_.@/+-]+|(?<=[^A-Za-z0-9_.@/+-])[_.@/+-]*)(?=[A-Za-z0-9])")
#: Characters before an identifier in which its two words are looked for.
REACH = 80
TABLE_BITS = 20


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base entities, in order."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        else:
            done = at + 1  # the local part ends before a sign @
        at = text.find("@", done)
    for zone in ZONE.finditer(text):
        run, shift = zone[0], zone.start()
        if len(run) < 7:
            continue
        for m in IP.finditer(run):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((shift + m.start(), 1, shift + m.end()))
        for m in CARD.finditer(run):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((shift + m.start(), 2, shift + m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def context_words(text: str) -> list[str]:
    return [w for w in (x.strip(TRIM).lower() for x in CONTEXT_WORD.findall(text)) if w]


def pattern_before(text: str, start: int) -> str | None:
    """The two words before a place, or None at a text's first words."""
    words = context_words(text[max(0, start - REACH) : start])
    return " ".join(words[-2:]) if len(words) >= 2 else None


def patterns_before(text: str, starts: list[int]) -> list[str]:
    """The pattern before every word, every token inside a word and every
    identifier (its places in order in ``starts``), once for each place."""
    out, n, i = [], len(starts), 0
    older = newer = None
    older_at = newer_at = 0
    for m in CONTEXT_WORD.finditer(text):
        raw, at, end = m[0], m.start(), m.end()
        word = raw.strip(TRIM)
        if not word:
            continue
        head = at + len(raw) - len(raw.lstrip(TRIM))
        if older is not None:
            # REACH cuts long words, also before an identifier
            before = f"{older} {newer}" if head - older_at <= REACH else pattern_before(text, head)
            if before:
                out.append(before)
        plain = word.isascii() and word.isalnum()
        if newer is not None and (not plain or (i < n and starts[i] < end)):
            places = [] if plain else [at + x.end() for x in INNER.finditer(raw[: REACH + 1])]
            while i < n and starts[i] < end:
                places.append(starts[i])
                i += 1
            for place in sorted(set(places)):
                prefix = text[at:place].strip(TRIM).lower()
                if prefix:  # else the word itself
                    before = f"{newer} {prefix}" if place - newer_at <= REACH else pattern_before(text, place)
                    if before:
                        out.append(before)
        older, older_at, newer, newer_at = newer, newer_at, word.lower(), at
        while i < n and starts[i] < end:
            i += 1
    return out


def other_identifiers(text: str, base) -> list[tuple[int, int]]:
    """(start, end) of identifier-like tokens that no base span overlaps."""
    out, done, i = [], 0, 0
    for m in DIGITS.finditer(text):
        if m.start() < done:
            continue
        a, b = m.start(), m.end()
        while a > done and text[a - 1] in TOKEN_CHARS:
            a -= 1
        while b < len(text) and text[b] in TOKEN_CHARS:
            b += 1
        done = b
        token = text[a:b]
        a += len(token) - len(token.lstrip(LEAD))
        token = text[a:b].rstrip(LEAD)
        b = a + len(token)
        if len(token) < 4 or sum(c.isdigit() for c in token) < 2:
            continue
        while i < len(base) and base[i][2] <= a:
            i += 1
        if not any(s < b and e > a for s, _, e in base[max(0, i - 1) : i + 4]):
            out.append((a, b))
    return out


def _found(docs: DataFrame) -> DataFrame:
    """Per row: base spans and the occurrences (pattern, instance, seed,
    start, end) of all identifiers in it."""
    schema = "row long, doc_id long, base array<struct<start:int,kind:int,end:int>>, occurrences array<struct<pattern:string,instance:string,seed:boolean,start:int,end:int>>"

    def run(batches) -> Iterator:
        import pyarrow as pa

        span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
        occurrence = pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("seed", pa.bool_()), ("start", pa.int32()), ("end", pa.int32())])
        for b in batches:
            spans, seen = [], []
            for text in b.column(2).to_pylist():
                base = base_spans(text)
                mine = [(a, e, True) for a, _, e in base] + [(a, e, False) for a, e in other_identifiers(text, base)]
                spans.append([{"start": a, "kind": k, "end": e} for a, k, e in base])
                placed = [(pattern_before(text, a), a, e, s) for a, e, s in mine]
                seen.append([{"pattern": p, "instance": text[a:e].lower(), "seed": s, "start": a, "end": e} for p, a, e, s in placed if p])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, pa.list_(span)), pa.array(seen, pa.list_(occurrence))], ["row", "doc_id", "base", "occurrences"])

    rows = texts(docs, F.monotonically_increasing_id().alias("row")).select("row", "doc_id", "text")
    return rows.mapInArrow(run, schema)


def _slot(pattern: str) -> int:
    return zlib.crc32(pattern.encode("utf-8", "surrogatepass")) & ((1 << TABLE_BITS) - 1)


def pattern_totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often the corpus has a word, token or identifier
    after each of ``patterns``. Workers count pairs whose hash is in a bit
    table of fixed size; the join leaves the patterns asked for."""
    spark = docs.sparkSession
    slots = patterns.select(F.crc32(F.col("pattern").cast("binary")).bitwiseAND(F.lit((1 << TABLE_BITS) - 1).cast("long")).alias("slot")).distinct()
    table = bytearray(1 << TABLE_BITS)
    for r in slots.toLocalIterator():  # at most 2 ** TABLE_BITS slots
        table[r[0]] = 1
    wanted = spark.sparkContext.broadcast(bytes(table))

    def run(batches) -> Iterator:
        import pyarrow as pa

        def out(counts):
            return pa.RecordBatch.from_pydict({"pattern": pa.array(list(counts), pa.string()), "total": pa.array(list(counts.values()), pa.int64())})

        bits, crc, mask, counts = wanted.value, zlib.crc32, (1 << TABLE_BITS) - 1, {}
        for b in batches:
            for text in b.column(0).to_pylist():
                base = base_spans(text)
                starts = sorted({a for a, *_ in base} | {a for a, _ in other_identifiers(text, base)})
                for pair in patterns_before(text, starts):
                    if bits[crc(pair.encode("utf-8", "surrogatepass")) & mask]:
                        counts[pair] = counts.get(pair, 0) + 1
            if len(counts) > 100_000:
                yield out(counts)
                counts = {}
        yield out(counts)

    counted = texts(docs).select("text").mapInArrow(run, "pattern string, total long")
    return counted.groupBy("pattern").agg(F.sum("total").alias("total")).join(patterns.select("pattern"), "pattern", "left_semi")


def confident_patterns(edges: DataFrame, totals: DataFrame, min_instances: int = 3, min_confidence: float = 0.6, rounds: int = 3) -> DataFrame:
    """(pattern, confidence) of the patterns that end with enough of both.
    ``edges``: pattern, instance, n, seed."""
    seeds = edges.select("pattern", "instance", "n", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("score"), "seed")
    scored, patterns = seeds, None
    for _ in range(rounds):
        by = scored.groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("mass"), F.sum("n").alias("seen"), F.sum(F.when(F.col("score") >= 0.5, 1).otherwise(0)).alias("known"))
        by = by.join(totals, "pattern").where(F.col("known") >= min_instances)
        patterns = written(by.select("pattern", (F.col("mass") / F.greatest("total", "seen")).alias("confidence")), "pii-patterns")
        noisy = F.log1p(-F.least("confidence", F.lit(0.999)))
        instances = edges.where("NOT seed").join(patterns, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(noisy))).alias("found"))
        scored = edges.join(instances, "instance", "left").select("pattern", "instance", "n", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("found", F.lit(0.0))).alias("score"), "seed")
        scored = written(scored, "pii-scores")
    return patterns.where(F.col("confidence") >= min_confidence)


def personal_data(docs: DataFrame, min_instances: int = 3, min_confidence: float = 0.6, rounds: int = 3) -> DataFrame:
    """doc_id, base counts (n_email, n_ip, n_card, n_phone), base_sha256,
    spans (base entities and discovered identifiers) and n_found, a row per
    document."""
    python_ready(docs.sparkSession)
    found = written(_found(docs), "pii-found")
    seen = found.select("row", F.inline("occurrences"))
    edges = written(seen.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "pii-edges")
    enough = edges.groupBy("pattern").agg(F.count("*").alias("k")).where(F.col("k") >= min_instances).select("pattern")
    enough = written(enough, "pii-candidates")
    totals = written(pattern_totals(docs, enough), "pii-totals")
    good = confident_patterns(edges, totals, min_instances, min_confidence, rounds)
    new = seen.where("NOT seed").join(good, "pattern").groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("id")).alias("kind"), "end")).alias("new"))
    out = found.join(new, "row", "left")
    names = F.lit(list(KINDS))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    everything = F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "new")))
    return out.select(
        "doc_id",
        *[count(k) for k in KINDS[:4]],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(everything).alias("spans"),
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_found"),
    )
