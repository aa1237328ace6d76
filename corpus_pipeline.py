"""The corpus pipeline: documents through quality rules to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwatch.llm import neardup, packing, pii, quality
from shelfwatch.llm.common import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, as they are."""
    return quality.quality(docs).filter("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return neardup.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data masked (and ``n_chars`` counted anew where it was)."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 1024 tokens at most."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packed),
]

#: Near duplicates, bootstrapped patterns and token ids are beyond SQL; tests/llm compares
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
