"""Addresses and layered configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.addr import host_of, port_of

# Defaults of the derived parameters.
DEFAULT_RM = "localhost"
DEFAULT_RM_PORT = 8088
DEFAULT_RM_PORT_HTTPS = 8090
DEFAULT_REPLICATION = 3

# Configuration keys the derived parameters read.
KEY_HOSTNAME = "yarn.resourcemanager.hostname"
KEY_WEBAPP = "yarn.resourcemanager.webapp.address"
KEY_WEBAPP_HTTPS = "yarn.resourcemanager.webapp.https.address"
KEY_REPLICATION = "dfs.replication"


def host_port(df: DataFrame, addr_col: str = "addr") -> DataFrame:
    a = F.col(addr_col)
    return df.withColumn("host", host_of(a)).withColumn("port", port_of(a))


def host_port_rollup(df: DataFrame, addr_col: str = "url") -> DataFrame:
    """Number of addresses per (host, port)."""
    a = F.col(addr_col)
    return (df.select(host_of(a).alias("host"), port_of(a).alias("port"))
            .groupBy("host", "port").agg(F.count(F.lit(1)).alias("n")))


def resolve_layers(rows: DataFrame, key: str = "key", by: tuple[str, ...] = ()) -> DataFrame:
    """The winning value per key when layers override each other: highest
    ``priority`` wins, then the latest ``seq`` within a layer (of any type that
    has an order). ``by`` names columns that keys belong to, such as a cluster.
    Map-side ``max_by``; a hot key is reduced before the shuffle."""
    return (rows.groupBy(*by, key)
            .agg(F.max_by(F.struct("layer", "value"), F.struct("priority", "seq")).alias("_w"))
            .select(*by, key, "_w.layer", "_w.value"))


def derive_parameters(raw: DataFrame, universe: DataFrame, cluster_key: str = "cluster_key",
                      universe_key: str = "node_id") -> DataFrame:
    """rm, rm_port, rm_port_https and replication_factor per member of
    ``universe``, from raw (cluster, key, value) rows.

    The web-app address wins over the host name and also gives the port; an
    address without a port leaves ``rm_port`` null, as in the reference.
    Defaults: localhost, 8088, 8090, 3.

    Where a key repeats in a cluster the last one wins: rows with ``priority``
    and ``seq`` are resolved by ``resolve_layers`` first. Without them no order is
    known; then the greatest text wins, and the greatest number for replication.
    """
    keys = [KEY_HOSTNAME, KEY_WEBAPP, KEY_WEBAPP_HTTPS, KEY_REPLICATION]
    raw = raw.filter(F.col("key").isin(*keys))
    if {"priority", "seq"} <= set(raw.columns):
        layer = F.col("layer") if "layer" in raw.columns else F.lit(None).cast("string")
        raw = resolve_layers(raw.withColumn("layer", layer), by=(cluster_key,))
    of = {k: F.when(F.col("key") == k, F.col("value")) for k in keys}
    wide = raw.groupBy(cluster_key).agg(
        *[F.max(of[k]).alias(f"_k{i}") for i, k in enumerate(keys[:3])],
        F.max(F.trim(of[KEY_REPLICATION]).try_cast("int")).alias("_k3"))
    hostname, webapp, https, repl = (F.col(f"_k{i}") for i in range(4))
    u = universe.select(F.col(universe_key)).join(
        wide.withColumnRenamed(cluster_key, universe_key), on=universe_key, how="left")
    rm = F.when(webapp.isNotNull(), host_of(webapp)).otherwise(F.coalesce(hostname, F.lit(DEFAULT_RM)))
    rm_port = F.when(webapp.isNotNull(), port_of(webapp)).otherwise(F.lit(DEFAULT_RM_PORT))
    rm_port_https = F.when(https.isNotNull(), port_of(https)).otherwise(F.lit(DEFAULT_RM_PORT_HTTPS))
    rf = F.coalesce(repl, F.lit(DEFAULT_REPLICATION))
    return u.select(universe_key, rm.alias("rm"), rm_port.alias("rm_port"),
                    rm_port_https.alias("rm_port_https"), rf.alias("replication_factor"))
