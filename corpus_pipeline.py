"""The corpus pipeline: quality rules, near duplicates, shared passages, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its
result is written to the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from perfkit.llm import byte_bpe, decontaminate, quality_rules, simhash_dups, substring_dedup
from perfkit.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality cascade rejects."""
    return quality_rules.quality_rules(docs).where("kept").select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash component."""
    return simhash_dups.one_per_component(docs)


def cut_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that an earlier document has."""
    return substring_dedup.without_shared(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents contaminated by benchmark items."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, checked by decoding."""
    return byte_bpe.bpe_roundtrip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                  public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good),
    ("simhash_dups", keep_one_of_near_copies),
    ("substring_dedup", cut_shared_passages),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode),
]

#: Neither the fingerprints' hash nor the encoder can be written in SQL; tests/llm compares the
#: pipeline with a single-process version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
