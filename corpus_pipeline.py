"""A training corpus from raw documents: quality, near-duplicates, personal data, mixture, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``; the last returns one row per
document of the mix (repeats included) with its token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm import budget_mix, pii_crf, quality_gam, simhash, spm_spans
from capstream.session import shared_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality model rejects."""
    model = quality_gam.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.keep_good(docs, model, 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return simhash.one_of_each(docs, words=4, distance=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the text."""
    clean = pii_crf.redact(docs, pii_crf.kept(spark))
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's target of words; a document taken twice is two rows."""
    return budget_mix.mixed(docs, weights=(1, 2, 3), max_repeat=3, seed=42)


def _tokens(ids, begins, ends, decoded, encoder) -> dict:
    return spm_spans.digests(ids, begins, ends, decoded, encoder) | {"ids": ids}


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with hashes of ids, decoded text and spans."""
    return spm_spans.encode_spans(docs, public_tokenizers.path("piece_bpe_32k.model"), _tokens, f"{spm_spans.DIGESTS}, ids array<int>")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("tokens", tokens)]

#: The stages' models and knapsack have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
