"""Final status and deadlines on streams, against batch operators."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetlens.operators import apps as A
from fleetlens.plans import fixtures as FX
from fleetlens.plans.views import Views
from fleetlens.session import scratch_path
from fleetlens.streaming import deadlines as DL
from fleetlens.streaming import final_status as FS


def add(app, key, n=1):
    return (app, "add", key, n, None)


def done(app, key, status=0):
    return (app, "completed", key, None, status)


class Stream:
    """Event files of one folder, run batch by batch with one checkpoint."""

    def __init__(self, spark, schema, run):
        self.spark, self.schema, self.run = spark, schema, run
        self.src, self.sink, self.ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))

    def feed(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.src)
        return self.run(self.spark, self.src, self.sink, self.ckpt)


def statuses(log):
    return {r.app_id: (r.requested, r.completed, r.failed, r.final_status) for r in FS.ended(log).collect()}


def test_status_is_told_once_all_are_in_and_replays_count_once(spark):
    s = Stream(spark, FS.EVENT, FS.run_final_status)
    log = s.feed(add("a", "r1", 2), add("b", "r1"), done("a", "c1"), done("a", "c1"))
    assert statuses(log) == {}
    log = s.feed(done("a", "c1", 0), done("a", "c2", 5), done("b", "c9"), add("b", "r1"))
    assert statuses(log) == {"a": (2, 2, 1, "FAILED"), "b": (1, 1, 0, "UNDEFINED")}
    # replays alone tell nothing anew
    before = log.count()
    log = s.feed(done("a", "c2", 5), done("b", "c9"), add("a", "r1", 2))
    assert log.count() == before
    # more containers open an application again
    log = s.feed(add("b", "r2", 2), done("b", "c10"))
    assert statuses(log) == {"a": (2, 2, 1, "FAILED")}
    log = s.feed(done("b", "c11", 1))
    assert statuses(log) == {"a": (2, 2, 1, "FAILED"), "b": (3, 3, 1, "FAILED")}


def test_odd_events(spark):
    s = Stream(spark, FS.EVENT, FS.run_final_status)
    log = s.feed((None, "add", "r", 1, None), ("a", "add", None, 1, None), ("a", "other", "x", 1, 1), ("a", None, "y", 1, 1),
                 ("a", "add", "r", None, None), ("a", "completed", "c", None, None), done("only-done", "c", 1))
    assert statuses(log) == {"a": (1, 1, 0, "UNDEFINED"), "only-done": (0, 1, 1, "FAILED")}


def test_stream_of_all_containers_equals_batch_with_a_hot_application(spark):
    containers = Views(spark, SF_SMALL).containers
    hot = spark.range(4000).select(
        F.format_string("container_1700000000000_999999999_01_%06d", F.col("id")).alias("container_id"),
        (F.col("id") % 7).alias("node_id"), F.lit(64).alias("memory_mb"), F.lit(1).alias("completed"),
        (F.col("id") == 77).cast("int").alias("exit_status"))
    rows = containers.unionByName(hot)
    src, files = FX.write_slices(spark, FX.container_events(rows), F.col("at"), "events")
    log = FS.run_final_status(spark, src, scratch_path(spark, "s"), scratch_path(spark, "c"), files)
    want = A.completion_summary(rows).filter("final_status <> 'RUNNING'")
    assert sorted(map(tuple, FS.ended(log).select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert statuses(log)["application_1700000000000_999999999"] == (4000, 4000, 1, "FAILED")
    assert log.select("batch_id").distinct().count() >= 2


def test_a_bucket_of_applications_is_read_and_written_once():
    class State:
        reads, writes, value = 0, 0, None

        def get(self):
            self.reads += 1
            return self.value

        def update(self, value):
            self.writes, self.value = self.writes + 1, value

    class Handle:
        state = State()

        def getValueState(self, name, schema):
            return self.state

    processor, apps = FS.StatusProcessor(), [f"a{i}" for i in range(500)]
    processor.init(Handle())
    rows = [Row(app_id=apps, requested=[1] * 500, completed=[0] * 500, failed=[0] * 500),
            Row(app_id=apps[:9], requested=[0] * 9, completed=[1] * 9, failed=[0, 1] * 4 + [0])]
    told = {r.app_id: r.final_status for r in processor.handleInputRows((0,), rows, None)}
    assert told == {a: ("UNDEFINED", "FAILED")[i % 2] for i, a in enumerate(apps[:9])}
    again = list(processor.handleInputRows((0,), [Row(app_id=["a0", "a9"], requested=[2, 0], completed=[0, 1], failed=[0, 0])], None))
    assert again == [Row(app_id="a0", requested=3, completed=1, failed=0, final_status="RUNNING"),
                     Row(app_id="a9", requested=1, completed=1, failed=0, final_status="UNDEFINED")]
    assert (Handle.state.reads, Handle.state.writes) == (2, 2)


# --- deadlines ------------------------------------------------------------------

STATE = "app_id long, ts timestamp, state string"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
HOUR = 3_600_000_000


def at(app, hours, state="RUNNING"):
    return (app, T0 + dt.timedelta(hours=hours) if hours is not None else None, state)


@pytest.fixture
def deadline_stream(spark):
    schema = spark.createDataFrame([], STATE).schema

    def run(spark, src, sink, ckpt):
        return DL.run_deadlines(spark, src, schema, sink, ckpt, 10 * HOUR, "2 hours")

    return Stream(spark, schema, run)


def judged(log):
    return {r.app_id: (r.wait_us, r.in_time) for r in log.collect()}


def test_overdue_without_another_event(deadline_stream):
    s = deadline_stream
    assert judged(s.feed(at(1, 0), at(2, 0), at(2, 3, "FINISHED"), at(3, 1), at(None, 1), at(4, None))) == {}
    # the watermark passes 10 h: only other applications' events come
    log = s.feed(at(9, 12.5))
    assert judged(log) == {1: (None, False), 2: (3 * HOUR, True)}
    log = s.feed(at(9, 13.5), at(3, 13, "KILLED"))
    assert judged(log) == {1: (None, False), 2: (3 * HOUR, True), 3: (None, False)}
    # an end that comes after the judgement changes nothing, and opens nothing
    log = s.feed(at(1, 14, "FINISHED"), at(9, 40, None))
    log = s.feed(at(8, 60))
    assert judged(log) == {1: (None, False), 2: (3 * HOUR, True), 3: (None, False), 9: (None, False)}
    assert log.count() == 4


def test_late_events_before_the_judgement_count(deadline_stream):
    s = deadline_stream
    s.feed(at(1, 5), at(2, 5))
    s.feed(at(1, 4, "FINISHED"), at(2, 3.5), at(7, 5.5))   # within the lateness, and behind it
    log = s.feed(at(7, 15.6))                              # watermark 13.6: application 2's time ran out at 13.5
    assert judged(log) == {2: (None, False)}
    log = s.feed(at(7, 16.1))                              # 14.1: application 1's at 14
    assert judged(log) == {2: (None, False), 1: (0, True)}


def test_exactly_at_the_limit_is_overdue(deadline_stream):
    s = deadline_stream
    s.feed(at(1, 0), at(1, 10, "FINISHED"), at(2, 0), (2, T0 + dt.timedelta(hours=10) - dt.timedelta(microseconds=1), "FAILED"))
    assert judged(s.feed(at(5, 30))) == {1: (None, False), 2: (10 * HOUR - 1, True)}


def test_deadlines_equal_the_batch_operator(spark):
    from fleetlens.plans.catalog import ONE_DAY_US, stream_deadlines

    got = {r.app_id: (r.wait_us, r.in_time) for r in stream_deadlines(spark, SF_SMALL).collect()}
    batch = {r.app_id: (r.wait_us if r.in_time else None, r.in_time)
             for r in A.time_to_terminal(Views(spark, SF_SMALL).state_events, ONE_DAY_US).collect()}
    assert got and all(batch[a] == x for a, x in got.items())
    assert len(batch) - len(got) < len(batch) / 2
