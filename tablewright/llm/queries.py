"""The registered queries of this subpackage: one ``opN_<name>`` an operator,
over its whole table with production parameters. ``ORACLE`` holds DuckDB SQL
where SQL can state the result; the other operators are held against
brute-force versions in ``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import decontam_qgram, divergence_trees, html_tagpath, language_id, license_scan, mix_wfq, pii_bootstrap, prefix_counts, quality_gam, quality_llr, simhash_anchor, token_files, whiten_cholqr
from .common import crc_bucket, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@register("op1_benchmark_decontamination")
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a region of a benchmark item."""
    return decontam_qgram.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


@register("op2_license_scan", license_scan.oracle_sql())
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return license_scan.license_scan(documents(spark, sf_dir)).withColumn("score", F.round("score", 6))


@register("op3_pii_bootstrap")
def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii_bootstrap.personal_data(documents(spark, sf_dir))


@register("op4_token_binary")
def op4_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token packs of all documents, written and read back."""
    path = scratch_path(spark, "op4-tokens")
    token_files.write_token_files(documents(spark, sf_dir), path, TOKENIZER)
    return token_files.read_token_files(spark, path)


@register("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_anchor.simhash_components(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned without the held-out quarter."""
    docs = documents(spark, sf_dir)
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    model = language_id.train(docs, ~held_out)
    return language_id.identified(docs, model, F.coalesce(held_out, F.lit(False)).alias("held_out"))


@register("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and verdict of every document; trusted are the documents
    labelled as good."""
    trusted = documents(spark, sf_dir, "labels").where("quality = 1")
    return quality_llr.quality_rules(documents(spark, sf_dir), trusted)


@register("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned without the held-out fifth."""
    docs = documents(spark, sf_dir)
    held_out = crc_bucket(F.col("doc_id"), 5) == 0
    model = quality_gam.train(docs, documents(spark, sf_dir, "labels"), ~held_out)
    scores = quality_gam.scored(docs, model, F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return scores.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document from its prefix table."""
    limit = 2048
    tables = prefix_counts.prefix_tables(documents(spark, sf_dir), TOKENIZER, limit)
    return tables.withColumn("over_limit", F.col("n_tokens") > limit)


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat('wfq:', CAST(doc_id AS VARCHAR))) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
total AS (SELECT CAST(sum(source_size) AS BIGINT) AS n FROM s),
w AS (
  SELECT *, CAST(list_extract([3, 1, 2], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)) AS DOUBLE) AS weight,
         source_size * CAST(2 AS DOUBLE) AS cap FROM s),
l AS (
  SELECT *, ((SELECT n FROM total) * CAST(1.5 AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
top AS (SELECT max(level) AS level FROM l WHERE cap > level * weight),
t AS (
  SELECT source, source_size, CASE WHEN top.level IS NULL THEN cap ELSE least(cap, top.level * weight) END AS target FROM l, top),
q AS (
  SELECT d.doc_id, d.source, d.size, d.h, t.source_size, t.target,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id) AS BIGINT) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, pass * source_size + cum - size AS start FROM q, (VALUES (0), (1)) v(pass) WHERE size > 0),
served AS (
  SELECT *, (start + size) / target AS finish, least(size, CAST(ceil(target - start) AS BIGINT)) AS words FROM p WHERE start < target),
stream AS (SELECT *, sum(words) OVER (ORDER BY finish, h, pass, doc_id ROWS UNBOUNDED PRECEDING) AS sent FROM served),
b AS (SELECT CAST(floor(n * 1.5) AS BIGINT) AS budget FROM total),
k AS (SELECT doc_id, sum(least(words, budget - (sent - words))) AS taken FROM stream, b WHERE budget > sent - words GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k ON q.doc_id = k.doc_id
"""


@register("op10_source_mixing", MIX_SQL)
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix_wfq.mix(documents(spark, sf_dir))


@register("op11_divergence_audit", divergence_trees.ORACLE_SQL)
def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every source differs from the others of its language, and where."""
    return divergence_trees.divergence_audit(documents(spark, sf_dir))


@register("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the first 8 whitened components."""
    return whiten_cholqr.whitened_embeddings(documents(spark, sf_dir, "embeddings"))


@register("op13_html_extraction")
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_tagpath.extracted(documents(spark, sf_dir, "pages"))
