"""Deadlines of applications on a stream, by event-time timers.

The wait for an application's end has a time limit. Here each application has a
timer at its first event plus the limit. When the watermark passes it, the
application is judged: in time if a terminal state was seen within the limit,
else overdue, and told so without another event of it being needed.

Events are reduced before the shuffle, within each Arrow batch, to one row per
application (first and last event, first terminal event); so a hot application
costs its task a row per batch. The watermark follows the last events.

An event that comes late but before its application is judged counts, and an
earlier first event moves the timer. What comes after the judgement changes
nothing: a judged application keeps a mark as its only state, and has no timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import fleetlens.operators.udf  # noqa: F401  (package functions pickle by value)
from fleetlens.operators.apps import is_terminal
from fleetlens.streaming.updates import run_stateful

JUDGED = "app_id bigint, first_us bigint, wait_us bigint, in_time boolean"


def deadline_ms(first_us: int, timeout_us: int) -> int:
    """The first whole millisecond at or after the deadline: timers and
    watermarks have milliseconds, events microseconds."""
    return -(-(first_us + timeout_us) // 1000)


class DeadlineProcessor(StatefulProcessor):
    """First event and first end of one application, until it is judged."""

    def __init__(self, timeout_us: int):
        self.timeout_us = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("app", "first_us bigint, end_us bigint, judged boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, end, judged = self.state.get() or (None, None, False)
        if judged:
            return
        before = first
        for r in rows:
            first = r.first_us if first is None else min(first, r.first_us)
            if r.end_us is not None:
                end = r.end_us if end is None else min(end, r.end_us)
        if first != before:
            if before is not None:
                self.handle.deleteTimer(deadline_ms(before, self.timeout_us))
            self.handle.registerTimer(deadline_ms(first, self.timeout_us))
        self.state.update((first, end, False))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first, end, _ = self.state.get()
        in_time = end is not None and end - first < self.timeout_us
        self.state.update((None, None, True))
        yield Row(app_id=key[0], first_us=first, wait_us=end - first if in_time else None, in_time=in_time)

    def close(self) -> None:
        pass


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = pa.Table.from_batches([b]).group_by("app_id").aggregate(
            [("us", "min"), ("us", "max"), ("end_us", "min")])
        last = pc.cast(t["us_max"], pa.timestamp("us", tz="UTC"))
        yield from pa.table([t["app_id"], t["us_min"], t["end_us_min"], last],
                            names=["app_id", "first_us", "end_us", "last"]).to_batches()


def deadlines(events: DataFrame, timeout_us: int, lateness: str, app_col: str = "app_id", ts_col: str = "ts",
              state_col: str = "state") -> DataFrame:
    """``app_id, first_us, wait_us, in_time`` of every application whose time
    has run out by the watermark, once, from a streaming DataFrame of state
    changes. ``wait_us`` is null for an application that is overdue.

    The watermark is the last event less ``lateness``. Events without an
    application or a time are left out; a null state is not terminal.
    """
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    flat = (events.filter(F.col(app_col).isNotNull() & F.col(ts_col).isNotNull())
            .select(F.col(app_col).cast("bigint").alias("app_id"), us.alias("us"),
                    F.when(is_terminal(F.col(state_col)), us).alias("end_us")))
    parts = flat.mapInArrow(_reduced, "app_id bigint, first_us bigint, end_us bigint, last timestamp")
    return (parts.withWatermark("last", lateness).groupBy("app_id")
            .transformWithState(DeadlineProcessor(timeout_us), JUDGED, "Append", "EventTime"))


def run_deadlines(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint_dir: str,
                  timeout_us: int, lateness: str, max_files_per_trigger: int = 1,
                  shape=lambda events: events) -> DataFrame:
    """Run ``deadlines`` over the files now in ``source_dir``, oldest first,
    and return all judgements so far; ``shape`` turns the files' rows into state
    changes."""
    log = run_stateful(spark, source_dir, schema, sink_dir, checkpoint_dir,
                       lambda events: deadlines(shape(events), timeout_us, lateness), max_files_per_trigger)
    return log.drop("batch_id")
