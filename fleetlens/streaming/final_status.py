"""The final status of applications, on a stream of requests and callbacks.

One stream carries what an application's master hears: containers asked for
(``add``) and completion callbacks (``completed``). Callbacks may be replayed, so
``dropDuplicates`` keeps the ids already seen as state of (application, event),
which spreads a hot application over all tasks. The events that are new are added
up per application within each task, and only the sums reach the applications'
state (``transformWithState``): requested, completed, failed, from which follows
the status last told. An application's state lies with that of others whose hash
falls into the same of ``BUCKETS`` buckets: a bucket is read and written once a
batch, whatever the number of its applications, as every access to state is a
message between Python and the JVM. A checkpoint goes with its number of buckets.

A row is sent when all requested containers have completed, once: FAILED if one
failed, else UNDEFINED (the master never sets success). Containers added
afterwards open the application again, which is sent as RUNNING; the next time
all are in, the status is sent anew. So the last row of an application is always
its status, equal to ``operators.apps.completion_summary`` of the same events.

State is never dropped: an application may always ask for more containers, and
callbacks carry no time from which on they could no longer be replayed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import fleetlens.operators.udf  # noqa: F401  (package functions pickle by value)
from fleetlens.streaming.updates import last_of_key, run_stateful

#: What the stream's files hold: ``kind`` is add or completed; ``event_key``
#: names the event within its application and kind (a request's number, a
#: container's id); ``amount`` counts containers of an add.
EVENT = T.StructType([
    T.StructField("app_id", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("event_key", T.StringType()), T.StructField("amount", T.LongType()),
    T.StructField("exit_status", T.LongType())])

COUNTS = "requested bigint, completed bigint, failed bigint"
#: The counters of a bucket's applications, one element each.
BUCKET = "app_id array<string>, requested array<bigint>, completed array<bigint>, failed array<bigint>"
BUCKETS = 2048
#: Events whose sums a task holds before it sends them.
HELD = 400_000
STATUS = f"app_id string, {COUNTS}, final_status string"


def status_of(requested: int, completed: int, failed: int) -> str:
    if completed < requested:
        return "RUNNING"
    return "FAILED" if failed else "UNDEFINED"


class StatusProcessor(StatefulProcessor):
    """Counters of a bucket's applications."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counters", BUCKET)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[str, tuple[int, int, int]] = {}
        for r in rows:
            for app, *more in zip(r.app_id, r.requested, r.completed, r.failed, strict=True):
                new[app] = tuple(map(sum, zip(new[app], more, strict=True))) if app in new else tuple(more)
        counters = {app: tuple(counts) for app, *counts in zip(*(self.state.get() or ((),) * 4), strict=True)}
        for app, more in new.items():
            before = counters.get(app)
            now = counters[app] = tuple(map(sum, zip(before, more, strict=True))) if before else more
            told, status = status_of(*before) if before else "RUNNING", status_of(*now)
            if status != told or status != "RUNNING" and now != (before or (0, 0, 0)):
                yield Row(app_id=app, requested=now[0], completed=now[1], failed=now[2], final_status=status)
        self.state.update((list(counters), *map(list, zip(*counters.values(), strict=True))))

    def close(self) -> None:
        pass


def _packed(parts: list[pa.Table]) -> pa.RecordBatch:
    """The sums of each bucket's applications, a row a bucket."""
    names = ["requested", "completed", "failed"]
    t = (pa.concat_tables(parts).group_by(["bucket", "app_id"], use_threads=False)
         .aggregate([(c, "sum") for c in names]).sort_by("bucket"))
    bucket = t["bucket"].to_numpy()
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    offsets = pa.array(np.append(starts, len(bucket)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, t[c].combine_chunks()) for c in ("app_id", *(f"{n}_sum" for n in names))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *lists], ["bucket", "app_id", *names])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0
    for b in batches:
        parts.append(pa.Table.from_batches([b]))
        size += len(b)
        if size >= HELD:
            yield _packed(parts)
            parts, size = [], 0
    if size:
        yield _packed(parts)


def final_status(events: DataFrame) -> DataFrame:
    """``app_id, requested, completed, failed, final_status`` of applications
    whose status changed, from a streaming DataFrame of ``EVENT`` columns.

    Events without an application or key are left out, as are kinds other than
    the two; a null exit status is no failure; an add without an amount asks for
    one container. An event that comes again, in the same batch or a later one,
    changes nothing.
    """
    add, done = F.col("kind") == "add", F.col("kind") == "completed"
    counts = (F.when(add, F.coalesce("amount", F.lit(1))).otherwise(0).cast("bigint").alias("requested"),
              F.when(done, 1).otherwise(0).cast("bigint").alias("completed"),
              F.when(done & (F.col("exit_status") != 0), 1).otherwise(0).cast("bigint").alias("failed"))
    new = (events.filter((add | done) & F.col("app_id").isNotNull() & F.col("event_key").isNotNull())
           .dropDuplicates(["app_id", "kind", "event_key"])
           .select(F.pmod(F.xxhash64("app_id"), F.lit(BUCKETS)).cast("int").alias("bucket"), "app_id", *counts))
    return new.mapInArrow(_sums, f"bucket int, {BUCKET}").groupBy("bucket").transformWithState(
        StatusProcessor(), STATUS, "Append", "None")


def run_final_status(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                     max_files_per_trigger: int = 1) -> DataFrame:
    """Run ``final_status`` over the event files now in ``source_dir`` and
    return the update log; a later call reads only new files and goes on with the
    state of the checkpoint."""
    return run_stateful(spark, source_dir, EVENT, sink_dir, checkpoint_dir, final_status, max_files_per_trigger)


def ended(log: DataFrame) -> DataFrame:
    """The applications that have a final status now."""
    return last_of_key(log, "app_id").filter(F.col("final_status") != "RUNNING")
