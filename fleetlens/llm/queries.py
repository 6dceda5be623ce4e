"""Registered queries of the corpus operators, at production parameters, each
over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import (
    bpe, divergence, exact_dedup, fingerprint, hmm, html_text, language_id, packing, pieces, runs, secret_scan, simhash,
    token_store)
from fleetlens.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as SentencePiece ids and back."""
    return pieces.round_trip(documents(spark, sf_dir))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents (3-word shingles, 2 bits)."""
    return simhash.simhash_groups(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts of all documents."""
    return bpe.token_counts(documents(spark, sf_dir))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a binary token store, read back by key."""
    return token_store.stored(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.packed(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that are equal up to white space."""
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and their edited texts, compared."""
    return fingerprint.edited_fingerprints(documents(spark, sf_dir))


def op9_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hidden Markov and unigram scores of all documents."""
    return hmm.scored(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return language_id.identified(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their terms."""
    return divergence.source_divergence(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, a tenth with a repeating tail."""
    return runs.run_digests(documents(spark, sf_dir))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secret_scan.secret_digests(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_html_text, op2_sentencepiece, op3_simhash, op4_token_counts, op5_token_store, op6_best_fit_packing, op7_exact_dedup, op8_fingerprints,
    op9_hmm_score, op10_language_id, op11_source_divergence, op12_periodic_runs, op13_secret_scan, pipeline)}
