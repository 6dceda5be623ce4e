"""Captured resource-manager REST responses as typed DataFrames.

Input: a text column with one response body per row (for example files of
JSON lines read with ``spark.read.text``). Each reader unwraps its envelope
with a declared schema; epoch-millisecond times become timestamps, with
``0`` (not set) as null. Narrow: no shuffle, no schema inference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import schemas
from fleetlens.sources.envelopes import flatten_envelope


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response bodies stored one per line; ``file`` keeps the source."""
    return spark.read.text(path).select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("file"))


def epoch_ms(col: str) -> Column:
    c = F.col(col)
    return F.when(c > 0, F.timestamp_millis(c))


def applications(df: DataFrame, body: str = "body") -> DataFrame:
    """``{"apps": {"app": [...]}}``; ``{"apps": null}`` gives no rows."""
    apps = flatten_envelope(df, body, "apps", "app", schemas.APPLICATION)
    return (apps.withColumn("started", epoch_ms("startedTime"))
            .withColumn("finished", epoch_ms("finishedTime")))


def app_attempts(df: DataFrame, body: str = "body") -> DataFrame:
    """``{"appAttempts": {"appAttempt": [...]}}``; a missing envelope gives
    no rows (the reference's guard has a misspelt key and raises)."""
    att = flatten_envelope(df, body, "appAttempts", "appAttempt", schemas.APP_ATTEMPT)
    return att.withColumn("started", epoch_ms("startTime")).withColumn("finished", epoch_ms("finishedTime"))


def containers(df: DataFrame, body: str = "body") -> DataFrame:
    """``{"containers": {"container": [...]}}``; an empty list gives no rows
    (the reference raises)."""
    return flatten_envelope(df, body, "containers", "container", schemas.CONTAINER)


def nodes(df: DataFrame, body: str = "body") -> DataFrame:
    """``{"nodes": {"node": [...]}}``."""
    return flatten_envelope(df, body, "nodes", "node", schemas.NODE)


def app_statistics(df: DataFrame, body: str = "body") -> DataFrame:
    """``{"appStatInfo": {"statItem": [...]}}``: application count per state."""
    return flatten_envelope(df, body, "appStatInfo", "statItem", schemas.APP_STAT_ITEM)


def unwrap_object(df: DataFrame, body: str, key: str, schema: T.StructType,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per response for single-object envelopes ``{key: {...}}``;
    responses without the key give no row."""
    wrapped = T.StructType([T.StructField(key, schema, True)])
    parsed = F.from_json(F.col(body), wrapped)[key]
    return df.select(*keep, parsed.alias("_o")).filter(F.col("_o").isNotNull()).select(*keep, "_o.*")


def cluster_metrics(df: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """``{"clusterMetrics": {...}}``: capacity as the admission check uses it."""
    return unwrap_object(df, body, "clusterMetrics", schemas.CLUSTER_METRICS, keep)


# --- what the operators take ----------------------------------------------------

def admission_nodes(df: DataFrame, body: str = "body", cluster: str = "cluster_id") -> DataFrame:
    """Node responses as the nodes of ``admission_check`` and
    ``capacity_rollup``: ``cluster_id, node_id, state, avail_mb, avail_vcores``.
    The responses' column ``cluster`` says whose they are; a node's id is its id,
    else its host name."""
    found = flatten_envelope(df, body, "nodes", "node", schemas.NODE, keep=(cluster,))
    return found.select(F.col(cluster).alias("cluster_id"), F.coalesce("id", "nodeHostName").alias("node_id"),
                        F.coalesce("state", F.lit("RUNNING")).alias("state"), F.col("availMemoryMB").alias("avail_mb"),
                        F.col("availableVirtualCores").alias("avail_vcores"))


def completion_containers(df: DataFrame, body: str = "body") -> DataFrame:
    """Container responses as the containers of ``completion_summary`` and
    the other operators on containers: ``container_id, node_id, state, memory_mb,
    completed, exit_status``. A container is completed in state COMPLETE; without
    an exit code it has not failed."""
    found = flatten_envelope(df, body, "containers", "container", schemas.CONTAINER)
    done = F.coalesce(F.col("state") == "COMPLETE", F.lit(False))
    return found.select(F.col("id").alias("container_id"), F.col("nodeId").alias("node_id"), "state",
                        F.col("totalMemoryNeededMB").alias("memory_mb"), done.cast("int").alias("completed"),
                        F.coalesce("exitCode", F.lit(0)).alias("exit_status"))
