"""Cluster capacity, storage need and admission of resource requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def capacity_rollup(nodes: DataFrame, by: str = "cluster_id") -> DataFrame:
    """Active nodes, available memory and vcores per cluster (what the
    resource manager's cluster metrics report), plus the largest node. Of
    nodes with a ``state`` only the running ones count."""
    if "state" in nodes.columns:
        nodes = nodes.filter(F.col("state") == "RUNNING")
    return nodes.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.sum("avail_mb").alias("total_mb"),
        F.sum("avail_vcores").alias("total_vcores"),
        F.max("avail_mb").alias("max_mb"),
        F.max("avail_vcores").alias("max_vcores"))


def storage_need(files: DataFrame, unit: int = 2 ** 20, by: str = "app",
                 capacity: DataFrame | None = None) -> DataFrame:
    """Sum of sizes of the files not already on ``hdfs://``, floor-divided
    by ``unit`` (MB by default). With ``capacity`` (``by``, ``free``) the
    result also says whether the need fits."""
    need = (files.filter(~F.col("path").startswith("hdfs://"))
            .groupBy(by)
            .agg(F.sum("size").alias("_bytes"))
            .select(by, F.expr(f"_bytes div {int(unit)}").alias("need")))
    if capacity is None:
        return need
    return (need.join(capacity, on=by, how="left")
            .withColumn("fits", F.coalesce(F.col("need") <= F.col("free"), F.lit(False))))


def _fit_by_vcores(nodes: DataFrame) -> DataFrame:
    """Per cluster and vcore need ``v`` (1 .. largest node), the most memory
    on one node that has at least ``v`` vcores. Exact for the strict fit test
    with rows = clusters x largest vcore count, not requests x nodes."""
    per_v = nodes.groupBy("cluster_id", "avail_vcores").agg(F.max("avail_mb").alias("mb"))
    expanded = per_v.filter(F.col("avail_vcores") >= 1).select(
        "cluster_id", "mb", F.explode(F.sequence(F.lit(1), F.col("avail_vcores"))).alias("vcores"))
    return expanded.groupBy("cluster_id", "vcores").agg(F.max("mb").alias("best_mb"))


def admission_check(requests: DataFrame, nodes: DataFrame, min_mb: int = 1024,
                    am_mb: int = 300, strict: bool = False) -> DataFrame:
    """Decide per request whether its cluster can take it; the first failing
    test wins:

    NO_NODES      fewer than one active node;
    MEMORY        total available MB < max(am_mb, min_mb) + n * max(mem, min_mb);
    VCORES        total available vcores < 1 + n * vcores;
    NO_NODE_FITS  no node can take one container;
    OK            otherwise.

    As in the reference, a node fits unless it is short of memory AND of
    vcores; ``strict=True`` asks for both. Nodes are rolled up per cluster
    first (one row per cluster), so the join never pairs requests with nodes.
    """
    caps = capacity_rollup(nodes)
    n = F.col("num_containers").cast("bigint")   # products stay exact in 64 bits
    mem = F.greatest(F.col("memory_mb"), F.lit(min_mb))
    need_mb = F.lit(max(am_mb, min_mb)) + n * mem
    need_vc = F.lit(1) + n * F.col("vcores")
    r = requests.join(caps, on="cluster_id", how="left")
    if strict:
        r = (r.join(_fit_by_vcores(nodes), on=["cluster_id", "vcores"], how="left")
             .withColumn("_fits", F.coalesce(F.col("best_mb") >= mem, F.lit(False))))
    else:
        r = r.withColumn("_fits", F.coalesce(
            (F.col("max_mb") >= mem) | (F.col("max_vcores") >= F.col("vcores")), F.lit(False)))
    decision = (F.when(F.coalesce(F.col("n_nodes"), F.lit(0)) < 1, "NO_NODES")
                .when(F.col("total_mb") < need_mb, "MEMORY")
                .when(F.col("total_vcores") < need_vc, "VCORES")
                .when(~F.col("_fits"), "NO_NODE_FITS")
                .otherwise("OK"))
    return r.select("request_id", decision.alias("decision"))
