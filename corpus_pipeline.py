"""A corpus pipeline over ``documents``: five stages, each one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``; the last returns, per written
document, its place and digest in the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontam_qgram, mix_wfq, quality_gam, simhash_anchor, token_files
from tablewright.llm.common import crc_bucket, documents, written
from tablewright.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    learnable = crc_bucket(F.col("doc_id"), 5) != 0
    model = quality_gam.train(docs, documents(spark, sf_dir, "labels"), learnable)
    return quality_gam.keep_good(docs, model, threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: shingles of 3 words, at
    most 3 differing bits."""
    return simhash_anchor.keep_one_per_component(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a region of the benchmark go."""
    return decontam_qgram.keep_uncontaminated(docs, documents(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time a document is taken."""
    return mix_wfq.mixed_documents(docs)


def token_binary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token packs of the mix, written and read back."""
    path = scratch_path(spark, "pipeline-tokens")
    token_files.write_token_files(docs, path, TOKENIZER)
    return token_files.read_token_files(spark, path)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_binary", token_binary),
]

#: The models, fingerprints, alignments and token ids of the stages cannot be
#: stated in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
