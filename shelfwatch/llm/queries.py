"""Registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chunks, counts, divergence, fim, idfile, license, neardup, packing, pii, quality, quoting, topk,
               toxicity)
from .common import scratch
from .oracles import oracle_sql  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens at most."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written in range-coded blocks, and read back."""
    target = scratch(spark, "ids")
    idfile.write_ids(_table(spark, sf_dir, "documents"), target, public_tokenizers.path("word_bpe_49k.json"))
    return idfile.document_digests(spark, target)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count of every document."""
    return counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents")).drop("k1", "k2")


def op5_topk_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector against all others."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digests(pii.find(_table(spark, sf_dir, "documents")))


def op7_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, and its place in the order of replies."""
    return quoting.reply_threads(_table(spark, sf_dir, "conversations")).select(
        "message.conv_id", "message.turn", "message.role", "body", "parent_turn", "root_turn", "depth",
        "n_quoted_lines", "n_linked")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.quality(_table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def op9_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document."""
    return chunks.chunk_encode(_table(spark, sf_dir, "documents"),
                               public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License texts and notices in every document."""
    return license.scan(_table(spark, sf_dir, "documents"))


def op11_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, and the offsets (start:end, code points) of toxic spans."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the fill-in-middle output of every document and of the text restored from it."""
    return fim.digests(fim.restored(fim.pieces(_table(spark, sf_dir, "documents"))))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most prominent terms."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_packing, op2_range_coded_ids, op3_token_counts, op4_hyperminhash, op5_topk_bound, op6_contextual_pii,
        op7_quote_linking, op8_quality_rules, op9_chunk_bpe, op10_license_scan,
        op11_toxic_spans, op12_fill_in_middle, op13_source_divergence)}
