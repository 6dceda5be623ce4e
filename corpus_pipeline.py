"""A pipeline from raw documents to packed sequences, over the whole table.

Each stage gets all documents its predecessor kept and decides about them by
one operator: what language ID rejects goes, of equal texts one stays, of near
copies one stays, and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm.common import documents, written
from fleetlens.llm.exact_dedup import without_copies
from fleetlens.llm.language_id import with_language
from fleetlens.llm.packing import packed
from fleetlens.llm.simhash import without_near_copies

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter,
    and those whose best language has a posterior below one half."""
    return with_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space the smallest doc_id stays."""
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the smallest doc_id stays."""
    return without_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("exact", exact), ("near", near), ("packing", packing)]

#: SQL can express neither language ID nor fingerprints nor packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the
    shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
