"""Inputs derived from the driver tables by Spark, in the shapes the
reference reads (FIXTURES.md): REST envelopes, error bodies, aggregated log
text, site XML files and a folder of event files for the stream.

Everything here is a Spark job over the whole table. File outputs go to a
fresh folder under the session's checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import ids
from fleetlens.session import materialize, scratch_path

# Cluster timestamp used in derived container ids.
CLUSTER_TS = "1700000000000"
# Container sequence per conversation role in derived logs.
ROLE_SEQ = {"system": "000001", "user": "000002", "assistant": "000003"}
# Events per envelope: envelopes group a bounded run of one app's events.
EVENTS_PER_ENVELOPE = 16


def app_envelopes(state_events: DataFrame) -> DataFrame:
    """``{"apps": {"app": [...]}}`` bodies, one per app and run of
    ``EVENTS_PER_ENVELOPE`` event ids; apps with ``app_id % 10 = 0`` get
    ``{"apps": null}`` (no apps), as the resource manager sends."""
    chunk = F.expr(f"event_id div {EVENTS_PER_ENVELOPE}")
    items = F.collect_list(F.struct(F.col("app_id").alias("id"), "event_id", "state"))
    body = F.to_json(F.struct(
        F.when(F.col("app_id") % 10 != 0, F.struct(items.alias("app"))).alias("apps")))
    return state_events.groupBy("app_id", chunk.alias("chunk")).agg(body.alias("body"))


APPS_PER_RESPONSE = 64


def padded(number: Column, width: int) -> Column:
    """Digits with zeros in front up to ``width``; longer numbers are whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), "0")


def application_id(app_id: Column) -> Column:
    return F.concat(F.lit(f"application_{CLUSTER_TS}_"), padded(app_id, 9))


def app_list_responses(apps: DataFrame) -> DataFrame:
    """``{"apps": {"app": [...]}}`` bodies with REST field names, one per
    run of ``APPS_PER_RESPONSE`` app ids; times as epoch milliseconds."""
    rec = F.struct(
        application_id(F.col("app_id")).alias("id"),
        "name", "state", F.unix_millis(F.col("started").cast("timestamp")).alias("startedTime"),
        F.lit(0).cast("bigint").alias("finishedTime"))
    page = F.expr(f"app_id div {APPS_PER_RESPONSE}")
    body = F.to_json(F.struct(F.struct(F.collect_list(rec).alias("app")).alias("apps")))
    return apps.groupBy(page.alias("page")).agg(body.alias("body"))


def error_body(event_id: Column, event_type: Column, props: Column) -> Column:
    """Failed-response bodies from ``events``: props behind a status line, as
    proxies send it (not JSON), when ``event_id % 7 = 0``; wrapped as a RemoteException with a
    message when ``% 11 = 0``, without one when ``% 13 = 0``."""
    cut = F.when(event_id % 7 == 0, F.concat(F.lit("503 Service Unavailable "), props)).otherwise(props)
    return (F.when(event_id % 11 == 0,
                   F.concat(F.lit('{"RemoteException": {"message": "'), event_type,
                            F.lit('", "body": '), cut, F.lit("}}")))
            .when(event_id % 13 == 0, F.concat(F.lit('{"RemoteException": '), cut, F.lit("}")))
            .otherwise(cut))


def conversation_container_id(conv_id: Column, suffix: Column) -> Column:
    return F.concat(F.lit(f"container_{CLUSTER_TS}_"), padded(conv_id, 9),
                    F.lit("_01_"), suffix)


def role_seq(role: Column) -> Column:
    return (F.when(role == "system", ROLE_SEQ["system"])
            .when(role == "user", ROLE_SEQ["user"])
            .otherwise(ROLE_SEQ["assistant"]))


def log_lines(conversations: DataFrame) -> DataFrame:
    """Aggregated-log text as ordered lines, one section per (conversation,
    role): a stderr block ``turns=N`` and a stdout block with the role's
    texts in turn order; every third turn's text begins like a container
    header but is none. Only counts and lengths are aggregated; the texts
    themselves stay one row each, ordered by ``(conv_id, role, part, turn)``.
    """
    stats = conversations.groupBy("conv_id", "role").agg(
        F.count(F.lit(1)).alias("turns"),
        (F.sum(F.length("text")) + F.count(F.lit(1)) - 1).alias("out_len"))
    cid = conversation_container_id(F.col("conv_id"), role_seq(F.col("role")))
    node = F.concat(F.lit("host_"), (F.col("conv_id") % 5).cast("string"))
    err = F.concat(F.lit("turns="), F.col("turns").cast("string"))
    header = F.concat(
        F.lit("Container: "), cid, F.lit(" on "), node,
        F.lit("\nLogType:stderr\nLogLength:"), F.length(err).cast("string"),
        F.lit("\nLog Contents:\n"), err,
        F.lit("\nLogType:stdout\nLogLength:"), F.col("out_len").cast("string"),
        F.lit("\nLog Contents:"))
    heads = stats.select("conv_id", "role", F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("turn"),
                         header.alias("value"))
    bodies = conversations.select("conv_id", "role", F.lit(1).alias("part"), "turn",
                                  F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Container: - "), "text"))
                                  .otherwise(F.col("text")).alias("value"))
    return heads.unionByName(bodies)


def write_container_logs(spark: SparkSession, conversations: DataFrame) -> str:
    """Write aggregated log files (many sections per file, grouped by
    conversation; the text writer ends every row with a newline) and return
    their folder."""
    path = scratch_path(spark, "container-logs")
    (log_lines(conversations)
     .repartition("conv_id").sortWithinPartitions("conv_id", "role", "part", "turn")
     .select("value").write.text(path))
    return path


def write_site_xml(spark: SparkSession, raw_config: DataFrame) -> str:
    """Configuration dumps in site-file XML, each ``<property>`` naming its
    cluster in ``<source>cluster-<key></source>``. One file per write task
    (clusters hashed over the tasks), so the file count follows the
    parallelism, not the number of clusters."""
    path = scratch_path(spark, "site-xml")
    (raw_config.select(F.col("key").alias("name"), "value",
                       F.concat(F.lit("cluster-"), F.col("cluster_key").cast("string")).alias("source"),
                       "cluster_key")
     .repartition(spark.sparkContext.defaultParallelism, "cluster_key")
     .drop("cluster_key")
     .write.format("xml").option("rootTag", "configuration").option("rowTag", "property")
     .save(path))
    return path


def write_text_files(spark: SparkSession, documents: DataFrame) -> str:
    """Documents as text files, a line end after each, in a folder per source:
    at most one file per write task and source."""
    path = scratch_path(spark, "text-files")
    (documents.select("source", "text").write.partitionBy("source")
     .option("compression", "none").text(path))
    return path


def copy_events(spark: SparkSession, events: DataFrame, n_files: int | None = None) -> str:
    """Events copied once into ``n_files`` parquet files (default one per
    core), as a stream source. A parquet file is read in splits, so a stream's
    batch is parallel however large its files are."""
    path = scratch_path(spark, "event-stream")
    events.repartition(n_files or spark.sparkContext.defaultParallelism).write.parquet(path)
    return path


#: Folders of events are written one after the other, so that their files'
#: times put them in this order on a stream.
SLICES = 4


def write_slices(spark: SparkSession, rows: DataFrame, slice_of: Column, name: str) -> tuple[str, int]:
    """``rows`` as the files of a stream source, slice 0 first; the folder and
    the number of files a slice has."""
    path, files = scratch_path(spark, name), spark.sparkContext.defaultParallelism
    held = materialize(spark, rows.withColumn("_slice", slice_of))
    for i in range(SLICES):
        held.filter(F.col("_slice") == i).drop("_slice").repartition(files).write.mode("append").parquet(path)
    return path, files


def container_events(containers: DataFrame) -> DataFrame:
    """What a master hears of its containers, with the slice in which it comes:
    every container is asked for by itself; the callbacks of completed ones come
    one slice later or in the same one, and those of a third of the nodes are
    replayed at the end."""
    cid = F.col("container_id")
    asked = F.pmod(F.xxhash64(cid), F.lit(SLICES - 1)).cast("int")
    app = ids.application_id(cid).alias("app_id")
    none = F.lit(None).cast("bigint")
    adds = containers.select(app, F.lit("add").alias("kind"), cid.alias("event_key"), F.lit(1).cast("bigint").alias("amount"),
                             none.alias("exit_status"), asked.alias("at"))
    done = containers.filter(F.col("completed") == 1)

    def callbacks(rows: DataFrame, at: Column) -> DataFrame:
        return rows.select(app, F.lit("completed").alias("kind"), cid.alias("event_key"), none.alias("amount"),
                           F.col("exit_status").cast("bigint").alias("exit_status"), at.alias("at"))

    return (adds.unionByName(callbacks(done, asked + F.pmod(F.col("node_id"), F.lit(2)).cast("int")))
            .unionByName(callbacks(done.filter(F.col("node_id") % 3 == 0), F.lit(SLICES - 1))))


def time_slice(events: DataFrame, ts: str = "ts") -> Column:
    """The slice of an event when the table's time is cut into equal parts."""
    first, last = events.agg(F.min(ts), F.max(ts)).select(
        *(F.unix_micros(F.col(c).cast("timestamp")) for c in (f"min({ts})", f"max({ts})"))).first()
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    width = max((last or 0) - (first or 0) + 1, 1)
    return F.floor((us - F.lit(first or 0)) * SLICES / width).cast("int")


QUEUE_FANOUT = 3


def queue_responses(queue_nodes: DataFrame) -> DataFrame:
    """``response, body``: scheduler responses with a tree of up to 256 queues
    each, node i under node (i - 1) div 3. Trees are put together from the
    deepest level up, one join on (response, parent) a level."""
    depths = [0]
    while depths[-1] < 255:
        depths.append(depths[-1] * QUEUE_FANOUT + QUEUE_FANOUT)  # the last node of each level
    own = queue_nodes.select("response", "node", F.expr(f"(node - 1) div {QUEUE_FANOUT}").alias("parent"),
                             F.to_json(F.struct(F.concat(F.lit("q"), "node").alias("queueName"), "state", "capacity",
                                                F.col("n_apps").alias("numApplications"))).alias("own"))
    below = None
    for last, before in zip(reversed(depths), [*reversed(depths[:-1]), -1], strict=True):
        level = own.filter((F.col("node") > before) & (F.col("node") <= last))
        if below is None:
            whole = level.withColumn("whole", F.col("own"))
        else:
            children = below.groupBy("response", F.col("parent").alias("node")).agg(
                F.array_join(F.array_sort(F.collect_list("whole")), ",").alias("children"))
            joined = level.join(children, ["response", "node"], "left")
            whole = joined.withColumn("whole", F.when(F.col("children").isNull(), F.col("own")).otherwise(
                F.concat(F.substring("own", 1, F.length("own") - 1), F.lit(',"queues":{"queue":['), "children", F.lit("]}}"))))
        below = whole.select("response", "parent", "whole")
    return below.select("response", F.concat(F.lit('{"scheduler":{"schedulerInfo":'), "whole", F.lit("}}")).alias("body"))


def node_responses(nodes: DataFrame) -> DataFrame:
    """``cluster_id, body``: node responses in pages of 64 node ids."""
    item = F.struct(F.col("node_id").cast("string").alias("id"), F.lit("RUNNING").alias("state"),
                    F.col("avail_mb").alias("availMemoryMB"), F.col("avail_vcores").alias("availableVirtualCores"))
    body = F.to_json(F.struct(F.struct(F.collect_list(item).alias("node")).alias("nodes")))
    return nodes.groupBy("cluster_id", F.expr("node_id div 64").alias("page")).agg(body.alias("body"))


def container_responses(containers: DataFrame) -> DataFrame:
    """Container responses, in pages of one application's containers on 64
    nodes."""
    item = F.struct(F.col("container_id").alias("id"), F.col("node_id").cast("string").alias("nodeId"),
                    F.when(F.col("completed") == 1, "COMPLETE").otherwise("RUNNING").alias("state"),
                    F.when(F.col("completed") == 1, F.col("exit_status")).alias("exitCode"))
    body = F.to_json(F.struct(F.struct(F.collect_list(item).alias("container")).alias("containers")))
    return containers.groupBy(ids.application_id(F.col("container_id")).alias("app_id"),
                              F.expr("node_id div 64").alias("page")).agg(body.alias("body"))


def write_site_layers(spark: SparkSession, site_properties: DataFrame) -> str:
    """The two site files of every cluster as configuration dumps in folders
    ``yarn-site`` and ``core-site``, one file per write task; a cluster's
    properties stand in one file, in their order."""
    path = scratch_path(spark, "site-layers")
    for layer in ("yarn-site", "core-site"):
        (site_properties.filter(F.col("layer") == layer)
         .repartition(spark.sparkContext.defaultParallelism, "cluster_key").sortWithinPartitions("cluster_key", "seq")
         .select(F.col("key").alias("name"), "value",
                 F.concat(F.lit("cluster-"), F.col("cluster_key").cast("string")).alias("source"))
         .write.format("xml").option("rootTag", "configuration").option("rowTag", "property").save(f"{path}/{layer}"))
    return path
