"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition is a run of (digest, smallest row) pairs. In each round
``fan_in`` neighbouring runs (log2(fan_in) binomial rounds at once) are merged:
their rows meet by (merged run, digest), are sorted, and of equal digests the
smallest identifier and the summed copies stay. After log_fan_in(partitions)
rounds one run, spread over all tasks by digest, holds each distinct text once;
the answers then go down the same tree to the rows.

A digest is verified at every level: SHA-256 is merged only together with an
independent 64-bit hash and the length of the same text, so rows whose
witnesses differ never share a class.

However many copies a text has, a merge sees it at most ``fan_in`` times per
run, and on the way down a leaf run's rows stay with their own run; no task
gets a whole class. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import SPACE, free_name, text_of, written

KEY = ["digest", "witness", "n_bytes"]


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space."""
    return F.regexp_replace(text_of(text), SPACE, " ")


def _merged(runs: DataFrame, fan_in: int) -> DataFrame:
    """One round: the struct's minimum makes Spark sort each side by the key
    and merge, before and after the exchange."""
    return (runs.withColumn("run", F.expr(f"run div {fan_in}"))
            .groupBy("run", *KEY)
            .agg(F.min("first").alias("first"), F.sum("copies").alias("copies")))


def _leaves(docs: DataFrame, doc_id: str, text: str, name: str) -> DataFrame:
    """``docs`` with a struct ``name``: doc_id, the text's digest, witness and
    length, and the row's number, whose upper bits are its input partition."""
    norm = free_name(docs.columns, f"{name}_norm")
    leaf = F.struct(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(norm, 256)).alias("digest"),
                    F.xxhash64(norm).alias("witness"), F.octet_length(norm).alias("n_bytes"),
                    F.monotonically_increasing_id().alias("row"))
    return docs.withColumn(norm, normalised(text)).withColumn(name, leaf).drop(norm)


def _classes(leaf: DataFrame, fan_in: int) -> DataFrame:
    """The rows of a written table of leaves with ``first`` (the struct of the
    row of their class that stays) and ``copies``."""
    leaf = leaf.withColumn("run", F.shiftright("row", 33))
    n_runs = (leaf.agg(F.max("run")).first()[0] or 0) + 1

    levels = [leaf.withColumn("first", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
              .withColumn("copies", F.lit(1).cast("long"))]
    while len(levels) == 1 or n_runs > 1:
        levels.append(_merged(levels[-1], fan_in))
        n_runs = -(-n_runs // fan_in)

    answer = levels[-1]
    for lower in reversed(levels[1:-1]):
        above = answer.withColumnRenamed("run", "parent")
        answer = (lower.select("run", F.expr(f"run div {fan_in}").alias("parent"), *KEY)
                  .join(above, ["parent", *KEY]).drop("parent"))
    return leaf.withColumn("run", F.expr(f"run div {fan_in}")).join(answer, ["run", *KEY])


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                fan_in: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normalised``; a null text counts as
    empty. Of equal texts the row with the smallest doc_id stays; a row
    without doc_id comes after all others, and of repeated rows one stays.
    An empty table gives an empty result. Other columns are not read.
    """
    leaf = written(_leaves(docs.select(doc_id, text), doc_id, text, "exact_leaf").select("exact_leaf.*"), "exact-rows")
    return _classes(leaf, fan_in).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   fan_in: int = 8) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    Rows are numbered once, in a written table, so that what is dropped is the
    same rows whichever executor is lost; only digests and numbers are merged."""
    key = free_name(docs.columns, "exact_key")
    marked = written(_leaves(docs, doc_id, text, key), "exact-marked")
    dropped = (_classes(marked.select(f"{key}.*"), fan_in).filter("row <> first.row")
               .select(F.col("row").alias(key)))
    return marked.join(dropped, marked[f"{key}.row"] == dropped[key], "left_anti").drop(key)
