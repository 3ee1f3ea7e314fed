"""Quality rules with a hashed n-gram log-likelihood ratio, all in Spark SQL.

Two multinomials over hashed word unigrams and bigrams, one of the trusted
documents and one of the whole raw corpus, are counted over all documents. A
text's ratio is the mean over its n-grams of the log of trusted over raw
probability; each document is kept or not by comparing it with one fixed
threshold. Base rules count words, signs, repeated lines and repeated word
windows inside the row. No text is shuffled: n-grams are counted map-side
into a fixed number of buckets, and a document's sums are complete in the
task that reads it.

Nulls and edges: a null text has no words and fails the base rules; if no
document is trusted every ratio is 0; rows that repeat are each returned; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"
#: Buckets of the multinomials: the size of every table that is broadcast.
BUCKETS = 1 << 16
MIN_WORDS = 50
#: Repeated windows of a text that are looked up one by one; a text with more
#: has its windows sorted (the same result).
FEW_REPEATS = 32
#: Ids of trusted documents that are broadcast; beyond it they are joined.
BROADCAST_IDS = 2_000_000
THRESHOLD = -0.1


def words(text: Column) -> Column:
    """Runs of other than ASCII white space."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def with_words(docs: DataFrame, *more: str | Column) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), words(F.col("text")).alias("w"), *more)


def ngrams(rows: DataFrame, *keep: str) -> DataFrame:
    """A row per word of ``w``: ``single``, the word's bucket, and ``pair``,
    that of the word and the next (null at the last). A text without words
    keeps one row of nulls."""
    places = rows.select(*keep, "w", F.posexplode_outer("w").alias("at", "word"))
    single = F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int")
    following = F.get("w", F.col("at") + 1)
    pair = F.pmod(F.xxhash64("word", following), F.lit(BUCKETS)).cast("int")
    return places.select(*keep, F.when(F.col("at").isNotNull(), single).alias("single"), F.when(following.isNotNull(), pair).alias("pair"))


def with_repeats(rows: DataFrame) -> DataFrame:
    """``n_repeat_words`` of ``w``: words inside 3-word windows that the text
    has twice or more. A text whose window hashes are all different ends
    there. Where few of them repeat, each window is looked up among those;
    else windows are sorted by hash and equal neighbours are repeats. Both
    ways give the places of repeats; the words they cover are counted along
    them."""
    keep = rows.columns
    hashes = "CASE WHEN size(w) >= 4 THEN transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END"
    ordered = "CASE WHEN size(array_distinct(h)) < size(h) THEN sort_array(h) END"
    twice = "array_distinct(filter(ordered, (x, i) -> x = get(ordered, i + 1)))"
    looked_up = "filter(sequence(0, size(h) - 1), i -> array_contains(twice, h[i]))"
    windows = f"CASE WHEN size(twice) > {FEW_REPEATS} THEN sort_array(transform(h, (x, i) -> struct(x AS h, i AS p))) END"
    neighbours = """
        sort_array(transform(filter(
          transform(windows, (x, i) -> struct(x.p AS p, coalesce(x.h = get(windows, i - 1).h, false) OR coalesce(x.h = get(windows, i + 1).h, false) AS twice)),
          x -> x.twice), x -> x.p))
    """
    covered = "coalesce(aggregate(places, struct(0L AS n, -3 AS last), (s, p) -> struct(s.n + least(3, p - s.last) AS n, p AS last), s -> s.n), 0L)"
    for name, sql in {
        "h": hashes,
        "ordered": ordered,
        "twice": f"CASE WHEN ordered IS NOT NULL THEN {twice} END",
        "windows": windows,
        "places": f"CASE WHEN windows IS NOT NULL THEN {neighbours} WHEN twice IS NOT NULL THEN {looked_up} END",
    }.items():
        rows = rows.withColumn(name, F.expr(sql))
    return rows.select(*keep, F.expr(covered).alias("n_repeat_words"))


def base_counts(docs: DataFrame) -> DataFrame:
    """row, doc_id, w and the base counts of every document."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CHAR))
    counted = with_words(docs).withColumn("lines", lines).select(
        "row",
        "doc_id",
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    return with_repeats(counted)


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, ratio): log of trusted over raw probability, add-one smoothed,
    over the n-grams of all documents; ``trusted`` holds doc_ids."""
    ids = written(trusted.select(F.col("doc_id").alias("_trusted")).where("_trusted IS NOT NULL").distinct(), "trusted-ids")
    few = ids.count() <= BROADCAST_IDS
    rows = with_words(docs).join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_trusted"), "left")
    words_of = ngrams(rows.select("w", F.col("_trusted").isNotNull().cast("int").alias("good")), "good")
    grams = words_of.select("good", F.explode(F.array("single", "pair")).alias("bucket")).where("bucket IS NOT NULL")
    counts = written(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good")), "ngram-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    raw, good = total["raw"] or 0, total["good"] or 0
    if not good:
        return counts.select("bucket", F.lit(0.0).alias("ratio"))
    return counts.select("bucket", (F.log((F.col("good") + 1) / F.lit(float(good + BUCKETS))) - F.log((F.col("raw") + 1) / F.lit(float(raw + BUCKETS)))).alias("ratio"))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, ratio (mean log-likelihood ratio
    of the text's n-grams) and kept, a row per document."""
    ratios = F.broadcast(written(log_ratios(docs, trusted).coalesce(1), "ngram-ratios"))  # at most BUCKETS rows
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    places = ngrams(base_counts(docs), "row", "doc_id", *counts)
    single = ratios.select(F.col("bucket").alias("single"), F.col("ratio").alias("r1"))
    pair = ratios.select(F.col("bucket").alias("pair"), F.col("ratio").alias("r2"))
    looked_up = places.join(single, "single", "left").join(pair, "pair", "left")
    # a document's counts are part of its key: the buffer is one sum
    scored = looked_up.groupBy("row", "doc_id", *counts).agg(F.sum(F.coalesce("r1", F.lit(0.0)) + F.coalesce("r2", F.lit(0.0))).alias("sum"))
    ratio = F.when(F.col("n_words") > 0, F.col("sum") / (2 * F.col("n_words") - 1)).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", *counts, failed.alias("base_failed"), ratio.alias("ratio")).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))
