"""

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables of ``sf_dir`` (or data Spark derives from them). Column names match
the DuckDB oracle in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators import apps as A
from fleetlens.operators import config as C
from fleetlens.operators import files as FL
from fleetlens.operators import resources as R
from fleetlens.operators.barrier import run_in_tasks, run_status
from fleetlens.operators.udf import map_partitions_with_outcome
from fleetlens.plans import fixtures as FX
from fleetlens.plans.views import Views
from fleetlens.session import materialize, scratch_path
from fleetlens.sources import envelopes as E
from fleetlens.sources import files as SF
from fleetlens.sources import log_ranges as LR
from fleetlens.sources import logs as L
from fleetlens.sources import queues as Q
from fleetlens.sources import rest as REST
from fleetlens.streaming import deadlines as DL
from fleetlens.streaming import final_status as FS
from fleetlens.streaming.completion import run_stream_completion

Query = Callable[[SparkSession, str], DataFrame]

ONE_DAY_US = 86_400_000_000


def app_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: completion and progress of every application, with its name
    (#12 -> #20 -> #21), matched on the whole application id; one without
    containers has requested nothing, so its progress is 0.1. The containers
    are aggregated once per application before the join with ``apps``."""
    v = Views(spark, sf_dir)
    summary = A.completion_summary(v.containers).withColumnRenamed("app_id", "application_id")
    apps = v.apps.select("app_id", "name", FX.application_id(F.col("app_id")).alias("application_id"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("requested", "completed", "failed")]
    return (apps.join(summary, on="application_id", how="left")
            .select("app_id", "name", *counts, F.coalesce("final_status", F.lit("UNDEFINED")).alias("final_status"))
            .withColumn("progress", A.progress_of(F.col("requested"), F.col("completed"))))


def flatten_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#1: state events as app-list envelopes (16 events per page, null list when app_id % 10 = 0), unwrapped again."""
    v = Views(spark, sf_dir)
    env = FX.app_envelopes(v.state_events)
    item = T.StructType([T.StructField("id", T.LongType()), T.StructField("event_id", T.LongType()),
                         T.StructField("state", T.StringType())])
    flat = E.flatten_envelope(env, "body", "apps", "app", item)
    return flat.select(F.col("id").alias("app_id"), "event_id", "state")


def rest_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``apps`` view as REST envelopes of the resource manager (64 apps
    per response), read back with the typed application reader."""
    v = Views(spark, sf_dir)
    body = FX.app_list_responses(v.apps)
    apps = REST.applications(body)
    return apps.select("id", "name", "state", F.col("started").cast("timestamp_ntz").alias("started"))


def error_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#2: event props as failed-response bodies, classified; count per status."""
    ev = Views(spark, sf_dir).events
    bodies = ev.select(FX.error_body(F.col("event_id"), F.col("event_type"), F.col("props")).alias("body"))
    return (E.split_error_responses(bodies, "body")
            .groupBy("status").agg(F.count(F.lit(1)).alias("n")))


def container_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#3: conversations written as aggregated container logs, parsed back per container and log type."""
    v = Views(spark, sf_dir)
    path = FX.write_container_logs(spark, v.conversations)
    return L.read_container_logs(spark, path, with_file=False)


def log_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#4: the text between <title> and </title> of every page."""
    pages = Views(spark, sf_dir).pages
    return L.extract_log_html(pages, "html", "<title>", "</title>", keep=("page_id",))


def site_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#5: raw config written as XML configuration dumps and read back with the site-file reader."""
    v = Views(spark, sf_dir)
    path = FX.write_site_xml(spark, v.raw_config)
    conf = SF.read_site_config(spark, path, glob="*.xml")
    key = F.regexp_extract(F.col("source"), r"^cluster-(\d+)$", 1).cast("bigint")
    return conf.select(key.alias("cluster_key"), "key", "value")


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#6: the .zip entries of the remote file manifest."""
    remote = Views(spark, sf_dir).remote_files
    return SF.filter_manifest(remote, ".zip").select("path", "size")


def whole_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#6: the .zip entries of the manifest of all documents."""
    return SF.filter_manifest(Views(spark, sf_dir).local_files, ".zip").select("path", "size")


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#6: all documents written as text files below a folder per source, the
    files listed; their bytes per folder."""
    path = FX.write_text_files(spark, Views(spark, sf_dir).documents)
    files = SF.list_files(spark, path, glob="*.txt")
    source = F.regexp_extract("path", r"/source=([^/]*)/", 1)
    return files.groupBy(source.alias("source")).agg(F.sum("size").alias("bytes"))


def killable_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#7: apps named etl that are not in a terminal state."""
    return A.select_killable(Views(spark, sf_dir).apps, name="etl")


def container_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#8: container id to state."""
    return A.container_status(Views(spark, sf_dir).containers)


def log_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#9: conversation turns as wide stdout/stderr logs, unpivoted, searched for a needle."""
    conv = Views(spark, sf_dir).conversations
    wide = conv.select(
        FX.conversation_container_id(F.col("conv_id"), FX.padded(F.col("turn"), 6))
        .alias("container_id"),
        F.col("text").alias("stdout"),
        F.concat(F.lit("role="), F.col("role")).alias("stderr"))
    return A.search_logs(A.unpivot_logs(wide), "tion")


def host_port_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#10: page URLs counted per host and port."""
    return C.host_port_rollup(Views(spark, sf_dir).pages, "url")


def normalize_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#11: URIs normalised and counted."""
    return FL.normalize_uris(Views(spark, sf_dir).uris, "uri")


def attribute_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#12: containers per app, matched on the application id in the container id."""
    v = Views(spark, sf_dir)
    return A.attribute_containers(v.containers, v.apps.withColumn("application_id", FX.application_id(F.col("app_id"))))


def reject_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#13: every container is asked for removal; only running ones are known."""
    c = Views(spark, sf_dir).containers
    return A.reject_unknown(c, c.filter(F.col("completed") == 0))


def upload_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#14: upload decision for every local file against the remote manifest."""
    v = Views(spark, sf_dir)
    return FL.upload_delta(v.local_files, v.remote_files)


def _env_num():
    return F.regexp_extract(F.col("env_name"), r"([0-9]+)$", 1).cast("int")


def cached_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#15: environments by fingerprint: reuse an archive, zip a folder or build."""
    # The fingerprints feed three inputs of the join; write them once.
    sets = materialize(spark, FL.set_fingerprint(Views(spark, sf_dir).packages, "env_name", "spec"))
    archives = sets.filter(_env_num() % 3 == 0)
    dirs = sets.filter(_env_num() % 3 == 1)
    return FL.resolve_cached_sets(sets, archives, dirs)


def admission_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#16: every request against its cluster's nodes."""
    v = Views(spark, sf_dir)
    return R.admission_check(v.requests, v.nodes)


def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#17: apps per state."""
    return A.state_counts(Views(spark, sf_dir).apps)


def capacity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#18: nodes rolled up per cluster."""
    return R.capacity_rollup(Views(spark, sf_dir).nodes)


def storage_need(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#19: local bytes per app in KB units (files already on hdfs:// excluded)."""
    return R.storage_need(Views(spark, sf_dir).local_files, unit=1024)


def completion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#20: requested, completed and failed containers per app."""
    return A.completion_summary(Views(spark, sf_dir).containers)


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#21: the master's progress figure per app."""
    return A.progress(A.completion_summary(Views(spark, sf_dir).containers))


def latest_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#22: ids of each app's last attempt."""
    return A.latest_attempt_containers(Views(spark, sf_dir).containers)


def used_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#23: containers still in use per app."""
    return A.used_containers(Views(spark, sf_dir).containers)


def set_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#24: SHA-1 of each environment's package set."""
    return FL.set_fingerprint(Views(spark, sf_dir).packages, "env_name", "spec")


def worker_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#25: all containers but each app's first."""
    return A.worker_containers(Views(spark, sf_dir).containers)


def first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#26: first package per leading word in each environment."""
    return FL.first_by_key(Views(spark, sf_dir).packages, "env_name", "spec", "pos")


def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#27: current state of every customer key as an app (NONE without events)."""
    v = Views(spark, sf_dir)
    universe = v.customer.select(F.col("c_custkey").alias("app_id"))
    return A.latest_state(v.state_events, universe)


def time_to_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#28: wait to the first terminal state, within one day or not."""
    return A.time_to_terminal(Views(spark, sf_dir).state_events, timeout_us=ONE_DAY_US)


def pool_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#29: requested and net container counts after each event."""
    return A.pool_size_over_time(Views(spark, sf_dir).state_events)


def resolve_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#30: the winning layer and value per config key."""
    return C.resolve_layers(Views(spark, sf_dir).config_layers)


def derive_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#31: resource-manager address, ports and replication per node."""
    v = Views(spark, sf_dir)
    return C.derive_parameters(v.raw_config, v.nodes)


def stream_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#32: completion counters per app from a stream of copied event files."""
    v = Views(spark, sf_dir)
    n_files = spark.sparkContext.defaultParallelism
    src = FX.copy_events(spark, v.events, n_files)
    out = scratch_path(spark, "completion-sink")
    ckpt = scratch_path(spark, "completion-ckpt")
    # two micro-batches whatever the number of files: state carries over
    # from the first to the second, and each batch is one distributed job
    return run_stream_completion(spark, src, v.events.schema, out, ckpt, app_col="user_id",
                                 failed=F.col("event_type") == "error",
                                 max_files_per_trigger=max(1, -(-n_files // 2)))


def stream_final_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#32: requests and callbacks of all containers on a stream, a third of the
    callbacks replayed; the final status of every application that has one."""
    src, files = FX.write_slices(spark, FX.container_events(Views(spark, sf_dir).containers), F.col("at"), "container-events")
    log = FS.run_final_status(spark, src, scratch_path(spark, "status-sink"), scratch_path(spark, "status-ckpt"), 2 * files)
    return FS.ended(log)


def stream_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#28 on a stream: every application whose day has run out by the
    watermark, with its wait if it ended in time."""
    events = Views(spark, sf_dir).state_events
    src, files = FX.write_slices(spark, events, FX.time_slice(events), "state-events")
    judged = DL.run_deadlines(spark, src, events.schema, scratch_path(spark, "deadline-sink"),
                              scratch_path(spark, "deadline-ckpt"), ONE_DAY_US, "6 hours", files)
    return judged.select("app_id", F.timestamp_micros("first_us").cast("timestamp_ntz").alias("first"), "wait_us", "in_time")


def log_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#3 with offsets: conversations as aggregated container logs, read by byte
    ranges; each section's bytes, and the place behind the section before it."""
    path = FX.write_container_logs(spark, Views(spark, sf_dir).conversations)
    found = LR.read_logs_with_offsets(spark, path)
    return found.select("container_id", "node_id", "log_type", "content", F.col("length").alias("section_bytes"))


def queue_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#1 at any depth: customers as queues of scheduler responses, read back
    with path and depth."""
    bodies = FX.queue_responses(Views(spark, sf_dir).queue_nodes)
    return (Q.queue_tree(bodies, keep=("response",))
            .select("response", "path", "depth", "queue", "state", "capacity", "n_apps"))


def _words_of_docs(batches):
    """The words of each document, counted where the documents are read: a
    barrier task reads a number for each of its documents, not their texts."""
    for b in batches:
        n_words = [len((t or "").encode().split()) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64())], ["doc_id", "n_words"])


def _count_words(batches, task) -> int:
    """The user function of the fixture: adds up its documents and their words,
    waits for the other tasks, and ends with status 3 if the count is odd."""
    n_docs = n_words = 0
    for b in batches:
        n_docs += len(b)
        n_words += sum(b.column(1).to_pylist())
    task.barrier()
    print(f"{n_docs} documents, {n_words} words", end="")
    return 3 * (n_words % 2)


def barrier_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#33 in four tasks at once over all documents; each task's outcome and the
    status of the run."""
    docs = Views(spark, sf_dir).documents.select("doc_id", "text")
    counted = docs.mapInArrow(_words_of_docs, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint")
    out = materialize(spark, run_in_tasks(counted, _count_words, 4, F.col("doc_id") % 4))
    return (out.select("task", "n_tasks", "exit_status", "output", "error")
            .join(run_status(out).select("n_tasks", "failed", "final_status"), "n_tasks"))


def site_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#5 into #30 into #31: two site files a cluster, with repeats; a later
    property and a later file override."""
    v = Views(spark, sf_dir)
    conf = SF.read_site_layers(spark, FX.write_site_layers(spark, v.site_properties), glob="*.xml")
    key = F.regexp_extract("source", r"^cluster-(\d+)$", 1).cast("bigint")
    return C.derive_parameters(conf.withColumn("cluster_key", key), v.nodes)


NEEDLES = ("tion", "ion", "on", "en", "the", "th", "role=user", "role=", "e e", ". ", "ung", "a" * 3)


def log_search_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#9 for many needles, some within others, in one pass."""
    conv = Views(spark, sf_dir).conversations
    wide = conv.select(
        FX.conversation_container_id(F.col("conv_id"), FX.padded(F.col("turn"), 6)).alias("container_id"),
        F.col("text").alias("stdout"), F.concat(F.lit("role="), F.col("role")).alias("stderr"))
    return A.search_many(A.unpivot_logs(wide), NEEDLES)


def malformed_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of #20, #23 and #25: container ids without the form."""
    return A.malformed(Views(spark, sf_dir).captured_containers)


def captured_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#20 over captured ids, malformed ones left out."""
    return A.completion_summary(Views(spark, sf_dir).captured_containers)


def channel_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#26 into #24 into #15: the first package of each leading word, with the
    environment's channels, fingerprinted; archives, folders or a build."""
    v = Views(spark, sf_dir)
    first = FL.first_by_key(v.packages, "env_name", "spec", "pos").select("env_name", "spec", F.lit(False).alias("channel"))
    specs = first.unionByName(v.channels.select("env_name", "spec", F.lit(True).alias("channel")))
    sets = materialize(spark, FL.set_fingerprint(specs, "env_name", "spec", channel="channel"))
    return FL.resolve_cached_sets(sets, sets.filter(_env_num() % 3 == 0), sets.filter(_env_num() % 3 == 1))


def rest_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#16 on captured node responses."""
    v = Views(spark, sf_dir)
    return R.admission_check(v.requests, REST.admission_nodes(FX.node_responses(v.nodes)))


def rest_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#20 on captured container responses."""
    return A.completion_summary(REST.completion_containers(FX.container_responses(Views(spark, sf_dir).containers)))


def _words_or_fail(text: str) -> int:
    """The user function of the fixture: words of a whole text; tables fail."""
    if "|" in text:
        raise ValueError("a table, not prose")
    return len(text.encode().split())


def map_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#33: a user function over whole documents, failing on those with a table; every document's outcome."""
    docs = Views(spark, sf_dir).documents
    out = map_partitions_with_outcome(docs, _words_or_fail, "text", T.LongType(), keep=("doc_id",))
    return out.select("doc_id", "status", F.col("result").alias("n_words"))


QUERIES: dict[str, Query] = {
    "app_progress": app_progress,
    "flatten_envelope": flatten_envelope,
    "rest_applications": rest_applications,
    "error_responses": error_responses,
    "container_logs": container_logs,
    "log_html": log_html,
    "site_config": site_config,
    "file_manifest": file_manifest,
    "whole_manifest": whole_manifest,
    "listed_files": listed_files,
    "killable_apps": killable_apps,
    "container_status": container_status,
    "log_search": log_search,
    "host_port_rollup": host_port_rollup,
    "normalize_uris": normalize_uris,
    "attribute_containers": attribute_containers,
    "reject_unknown": reject_unknown,
    "upload_delta": upload_delta,
    "cached_sets": cached_sets,
    "admission_check": admission_check,
    "state_counts": state_counts,
    "capacity_rollup": capacity_rollup,
    "storage_need": storage_need,
    "completion_summary": completion_summary,
    "progress": progress,
    "latest_attempt": latest_attempt,
    "used_containers": used_containers,
    "set_fingerprint": set_fingerprint,
    "worker_containers": worker_containers,
    "first_by_key": first_by_key,
    "latest_state": latest_state,
    "time_to_terminal": time_to_terminal,
    "pool_size": pool_size,
    "resolve_layers": resolve_layers,
    "derive_parameters": derive_parameters,
    "stream_completion": stream_completion,
    "map_outcome": map_outcome,
    "stream_final_status": stream_final_status,
    "stream_deadlines": stream_deadlines,
    "log_sections": log_sections,
    "queue_tree": queue_tree,
    "barrier_run": barrier_run,
    "site_parameters": site_parameters,
    "log_search_many": log_search_many,
    "malformed_containers": malformed_containers,
    "captured_summary": captured_summary,
    "channel_sets": channel_sets,
    "rest_admission": rest_admission,
    "rest_completion": rest_completion,
}
