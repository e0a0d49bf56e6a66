"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.llm import bpe, decontaminate, exact_dedup, factorization, minhash
from savora.llm.text import prepare
from savora.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored one half or more by a machine fitted to the labels."""
    machine = factorization.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return factorization.keep_good(docs, machine)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the documents that are equal but for white space."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component linked by 80 % of five-word shingles."""
    return minhash.drop_near_copies(docs, minhash.Near(words=5, percent=80))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items cut out; documents that are such passages for the most part go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text_sha256``; the digest is that of the decoded text."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.round_trip(docs, vocabulary)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("text", 256).alias("text_sha256"))


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

# The stages learn a classifier, walk links and merge byte pairs, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has stored."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
