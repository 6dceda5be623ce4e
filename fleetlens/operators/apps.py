"""Applications, containers and state changes.

All operators are ``DataFrame -> DataFrame`` and stay JVM-side. Grouping is
by application; where a hot application could hold a large share of rows,
the plan uses partial (map-side) aggregation, a join on a unique key, or
running sums that cut only hot applications into time slices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

import fleetlens.operators.udf  # noqa: F401  (package functions pickle by value)
from fleetlens.functions import ids
from fleetlens.functions.running import running_sums
from fleetlens.session import materialize

# The terminal application states.
TERMINAL_STATES = ("FINISHED", "FAILED", "KILLED")
LINE_END = re.compile("\n")


def is_terminal(state: Column) -> Column:
    return F.coalesce(state.isin(*TERMINAL_STATES), F.lit(False))


# --- projections and filters ----------------------------------------------

def select_killable(apps: DataFrame, name: str | None = None) -> DataFrame:
    """Apps that may still be killed: not in a terminal state and, when
    ``name`` is given, with that name (the launcher's own apps); ``None``
    takes every name. A null state counts as not terminal, as in the
    reference."""
    cond = ~is_terminal(F.col("state"))
    if name is not None:
        cond = cond & (F.col("name") == F.lit(name))
    return apps.filter(cond).select("app_id", "state")


def container_status(containers: DataFrame) -> DataFrame:
    """``container_id -> state``. Uses a ``state`` column when present, else
    COMPLETE / RUNNING from the ``completed`` flag."""
    if "state" in containers.columns:
        state = F.col("state")
    else:
        state = F.when(F.col("completed") == 1, "COMPLETE").otherwise("RUNNING")
    return containers.select("container_id", state.alias("state"))


def unpivot_logs(wide: DataFrame, id_col: str = "container_id",
                 log_types: tuple[str, ...] = ("stdout", "stderr")) -> DataFrame:
    """One row per (container, log type) from one column per log type, in
    the reference's print order (stdout, then stderr)."""
    return wide.unpivot([id_col], list(log_types), "log_type", "content")


def search_logs(logs: DataFrame, needle: str, id_col: str = "container_id") -> DataFrame:
    """Containers and log types whose content has ``needle`` on some line,
    with the number of such lines."""
    lines = F.split(F.col("content"), "\n")
    hits = F.size(F.filter(lines, lambda ln: ln.contains(needle)))
    return (logs.select(id_col, "log_type", hits.alias("n_lines"))
            .filter(F.col("n_lines") > 0))


def search_many(logs: DataFrame, needles: Sequence[str], id_col: str = "container_id") -> DataFrame:
    """``id_col, log_type, needle, n_lines``: for every needle at once, the
    lines of a log that have it (overlapping needles each count; a line counts
    once a needle). Logs without a needle give no row for it, nor do null logs.

    One pass of an automaton over each log finds all needles together, however
    many they are; ``search_logs`` reads every line once a needle. Needles are
    parameters of the query, not data; an empty one, or one with a line end, is an
    error.
    """
    wanted = list(dict.fromkeys(needles))
    if not wanted or not all(wanted) or any("\n" in n for n in wanted):
        raise ValueError("needles must be non-empty and without line ends")
    src = logs.select(id_col, "log_type", "content")
    schema = T.StructType([*src.schema.fields[:2], T.StructField("needle", T.StringType()),
                           T.StructField("n_lines", T.IntegerType())])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for i, n in enumerate(wanted):
            automaton.add_word(n, i)
        automaton.make_automaton()
        names = pa.array(wanted)
        for b in batches:
            row, needle, count = [], [], []
            for r, text in enumerate(b.column(2).to_pylist()):
                found = np.array(list(automaton.iter(text or "")), np.int64).reshape(-1, 2)
                if len(found):
                    ends = np.array([m.start() for m in LINE_END.finditer(text)], np.int64)
                    line = np.searchsorted(ends, found[:, 0])
                    which, n = np.unique(np.unique(found[:, 1] * (len(ends) + 1) + line) // (len(ends) + 1),
                                         return_counts=True)
                    row += [r] * len(which)
                    needle += which.tolist()
                    count += n.tolist()
            kept = b.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), names.take(pa.array(needle, pa.int64())), pa.array(count, pa.int32())],
                names=schema.names)

    return src.mapInArrow(hits, schema)


# --- aggregates ------------------------------------------------------------

def state_counts(apps: DataFrame) -> DataFrame:
    return apps.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def with_app_id(containers: DataFrame, key: str = "application") -> DataFrame:
    """Add ``app_id`` derived from the container id: ``application_<ts>_<seq>``
    (``key="application"``) or the sequence number as a long (``"number"``)."""
    if key == "number":
        return containers.withColumn("app_id", ids.app_number(F.col("container_id")))
    return containers.withColumn("app_id", ids.application_id(F.col("container_id")))


def well_formed(containers: DataFrame, observed: Observation | None = None) -> DataFrame:
    """The rows whose container id has a container id's form; others (null
    ids too) belong to no application. ``observed`` gets ``n_rows`` and
    ``n_malformed`` of whatever action runs the result; ``malformed`` gives the rows."""
    ok = F.coalesce(ids.is_container_id(F.col("container_id")), F.lit(False))
    if observed is not None:
        containers = containers.observe(observed, F.count(F.lit(1)).alias("n_rows"), F.count_if(~ok).alias("n_malformed"))
    return containers.filter(ok)


def malformed(containers: DataFrame) -> DataFrame:
    """``container_id, n, reason`` of the ids that have not the form: what the
    aggregates by application leave out. Partial counts by id, so that one id in
    many rows is reduced before the shuffle."""
    cid = F.col("container_id")
    reason = (F.when(cid.isNull(), "null").when(~cid.startswith("container_"), "prefix")
              .when(F.size(F.split(cid, "_")) < 5, "parts").otherwise("form"))
    return (containers.filter(~F.coalesce(ids.is_container_id(cid), F.lit(False)))
            .groupBy("container_id").agg(F.count(F.lit(1)).alias("n")).withColumn("reason", reason))


def completion_summary(containers: DataFrame, key: str = "application",
                       observed: Observation | None = None) -> DataFrame:
    """Requested, completed and failed containers per application. Malformed
    ids count for no application (``well_formed``).

    ``final_status`` follows the master's completion callback: FAILED once
    every requested container completed and at least one failed; UNDEFINED
    when all completed without failure (the reference never sets a success
    status there); RUNNING while some are outstanding. One hash aggregate
    with map-side partial counts.
    """
    c = with_app_id(well_formed(containers.select("container_id", "completed", "exit_status"), observed), key)
    done = F.col("completed") == 1
    agg = c.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(done).alias("completed"),
        F.count_if(done & (F.col("exit_status") != 0)).alias("failed"))
    final = (F.when(F.col("completed") < F.col("requested"), "RUNNING")
             .when(F.col("failed") > 0, "FAILED")
             .otherwise("UNDEFINED"))
    return agg.withColumn("final_status", final)


def progress_of(requested: Column, completed: Column) -> Column:
    """``0.1 + completed / (requested * 0.9)``, or 0.1 with nothing requested.
    As in the reference, this reaches about 1.211 at completion."""
    return (F.when(requested > 0, F.lit(0.1) + completed / (requested * F.lit(0.9)))
            .otherwise(F.lit(0.1))).cast("double")


def progress(summary: DataFrame) -> DataFrame:
    return summary.select("app_id", progress_of(F.col("requested"), F.col("completed")).alias("progress"))


def latest_attempt_containers(containers: DataFrame) -> DataFrame:
    """Ids of the containers of each application's last attempt, sorted and
    joined by ``,``. Ids are gathered by attempt, after a partial aggregate, and
    the last attempt of an application is the maximum of its attempts' rows; no
    task sorts or holds an application's earlier attempts beside it. The output
    row of an application holds all ids of its last attempt by definition.
    Malformed ids are left out."""
    c = with_app_id(well_formed(containers)).select(
        "app_id", "container_id", ids.attempt(F.col("container_id")).alias("attempt"))
    last = c.groupBy("app_id").agg(F.max("attempt").alias("attempt"))
    return (c.join(last, ["app_id", "attempt"]).groupBy("app_id")
            .agg(F.array_join(F.array_sort(F.collect_list("container_id")), ",").alias("ids")))


def used_containers(containers: DataFrame, observed: Observation | None = None) -> DataFrame:
    """Containers still in use per application. Malformed ids are left out."""
    c = with_app_id(well_formed(containers, observed))
    return c.groupBy("app_id").agg(F.count_if(F.col("completed") == 0).alias("n_used"))


# --- ordering and latest values ---------------------------------------------

def worker_containers(containers: DataFrame, observed: Observation | None = None) -> DataFrame:
    """All containers but the first id of each application (the master's).
    Malformed ids are neither workers nor masters.

    The first id per app comes from a partial (map-side) ``min``, so a hot
    application is reduced before the shuffle, and is removed by an anti join
    on the unique container id instead of a window over each application.
    (``min`` of a string is a sort-based aggregate in Spark.)
    """
    c = with_app_id(well_formed(containers.select("container_id"), observed))
    first = c.groupBy("app_id").agg(F.min("container_id").alias("container_id")).select("container_id")
    return c.join(first, on="container_id", how="left_anti")


def latest_state(events: DataFrame, universe: DataFrame, key: str = "app_id") -> DataFrame:
    """Current state of each application of ``universe``: the state of its
    latest event by (ts, event_id), or ``NONE`` when there is none (the
    reference returns NONE for any failed lookup)."""
    latest = events.groupBy(key).agg(
        F.max_by("state", F.struct("ts", "event_id")).alias("state"))
    return (universe.select(key).join(latest, on=key, how="left")
            .select(key, F.coalesce(F.col("state"), F.lit("NONE")).alias("state")))


def time_to_terminal(events: DataFrame, timeout_us: int = 10_000_000) -> DataFrame:
    """Microseconds from an application's first event to its first terminal
    state, and whether that came within ``timeout_us`` ("ended in time", not
    "succeeded"; default 10 s as the reference's wait)."""
    agg = events.groupBy("app_id").agg(
        F.min("ts").alias("_first"),
        F.min(F.when(is_terminal(F.col("state")), F.col("ts"))).alias("_end"))
    wait = F.timestamp_diff("MICROSECOND", F.col("_first"), F.col("_end"))
    return agg.select(
        "app_id", wait.alias("wait_us"),
        F.coalesce(wait < F.lit(timeout_us), F.lit(False)).alias("in_time"))


def pool_size_over_time(events: DataFrame, removal_state: str = "FAILED",
                        bucket: Column | None = None) -> DataFrame:
    """Requested containers after each event of an application: every event
    is an add of one container except ``removal_state``, a removal. As in the
    master, a removal does not lower ``requested``; ``net`` shows the count
    with removals taken off.

    Running sums per application (see ``running_sums``). Events are dealt by
    ranges of (application, time, event), so a hot application or a burst of
    its events spans as many partitions as it needs; the ranges are
    checkpointed and serve as buckets. ``bucket`` overrides them with any
    expression that does not decrease along (ts, event_id).
    """
    removal = F.col("state") == F.lit(removal_state)
    vals = {
        "requested": F.when(removal, 0).otherwise(1),
        "net": F.when(removal, -1).otherwise(1),
    }
    base = events.select("event_id", "app_id", "ts", "state")
    if bucket is None:
        ranged = (base.repartitionByRange("app_id", "ts", "event_id")
                  .withColumn("_range", F.spark_partition_id().cast("bigint")))
        base, bucket = materialize(events.sparkSession, ranged), F.col("_range")
    out = running_sums(base, ["app_id"], ["ts", "event_id"], vals, bucket)
    return out.select("event_id", "app_id", "requested", "net")


# --- joins --------------------------------------------------------------

def attribute_containers(containers: DataFrame, apps: DataFrame) -> DataFrame:
    """Containers per application, matched by cluster timestamp and application
    number together: another cluster, or the same one after a restart, counts
    from one again. ``apps`` has ``application_id``
    (``application_<ts>_<number>``) beside its columns.

    Containers are pre-aggregated per application before the join, so the
    join sees one row per app on both sides; AQE broadcasts the smaller side
    when its measured size allows, else sort-merge joins on the same key the
    aggregate shuffled on.
    """
    per_app = (containers
               .select(ids.application_id(F.col("container_id")).alias("application_id"), "memory_mb")
               .groupBy("application_id")
               .agg(F.count(F.lit(1)).alias("n_containers"),
                    F.sum("memory_mb").alias("memory_mb")))
    return (apps.select("app_id", "name", "application_id").join(per_app, on="application_id", how="inner")
            .drop("application_id"))


def reject_unknown(requests: DataFrame, known: DataFrame, key: str = "container_id") -> DataFrame:
    """Requested ids that are not known (the reference raises on these)."""
    return requests.select(key).join(known.select(key), on=key, how="left_anti")
