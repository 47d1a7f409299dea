"""A training corpus from ``documents``: language, near copies, repeated passages, benchmark leaks, token ids.

Each stage takes all rows its predecessor kept and returns the columns of ``documents``; the last one
returns token ids. ``run`` writes each stage's rows as Parquet in the shared checkpoint folder and
reads them back, so a stage that fails starts from stored rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnup.llm import bpe, decontaminate, language_id, simhash_dedup, suffix_dedup
from burnup.llm.base import ship, stored

TOKENIZER = "word_bpe_49k.json"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a main language go."""
    ship(spark)
    return language_id.keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest doc_id."""
    ship(spark)
    return simhash_dedup.keep_first(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go from the text; n_chars follows the text."""
    ship(spark)
    out = suffix_dedup.dedup_texts(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of the texts that are left."""
    ship(spark)
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", passages),
    ("benchmark_decontamination", benchmark),
    ("bpe_encode", tokens),
]

#: The fingerprints' hash, the mixture's rounds and the merges aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
