"""Streaming counters equal the batch aggregate; UDF outcomes per row."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from fleetlens.operators.udf import map_partitions_with_outcome
from fleetlens.plans import fixtures as FX
from fleetlens.session import scratch_path
from fleetlens.streaming.completion import completion_counts, run_stream_completion


def test_stream_equals_batch(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = FX.copy_events(spark, events, n_files=5)
    failed = F.col("event_type") == "error"
    out = run_stream_completion(spark, src, events.schema, scratch_path(spark, "sink"),
                                scratch_path(spark, "ckpt"), "user_id", failed)
    batch = completion_counts(events, "user_id", failed)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))
    # several micro-batches really ran
    assert spark.read.parquet(out.inputFiles()[0].rsplit("/batch_id=", 1)[0]) \
        .select("batch_id").distinct().count() >= 2


def test_outcome_per_row(spark):
    def _fn(x):
        if x < 0:
            raise ValueError("negative")
        return x * 2

    df = spark.createDataFrame([(i, i - 3) for i in range(10)], "id long, x long")
    out = map_partitions_with_outcome(df, _fn, "x", T.LongType(), keep=("id",), num_partitions=3)
    rows = {r.id: (r.status, r.result, r.error) for r in out.collect()}
    assert rows[0] == ("error", None, "ValueError: negative")
    assert rows[5] == ("ok", 4, None)
    assert sum(1 for v in rows.values() if v[0] == "ok") == 7


def test_outcome_per_batch(spark):
    df = spark.createDataFrame([(i, i) for i in range(6)], "id long, x long")

    def whole(s):
        return s + 1

    out = map_partitions_with_outcome(df, whole, "x", T.LongType(), keep=("id",), per_row=False)
    assert sorted(r.result for r in out.collect()) == [1, 2, 3, 4, 5, 6]

    def boom(s):
        raise RuntimeError("batch failed")

    bad = map_partitions_with_outcome(df, boom, "x", T.LongType(), keep=("id",), per_row=False)
    assert {r.status for r in bad.collect()} == {"error"}


def test_stream_restarts_from_its_checkpoint(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    failed = F.col("event_type") == "error"
    src, sink, ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))
    first = events.filter(F.col("event_id") % 2 == 0)
    second = events.filter(F.col("event_id") % 2 == 1)
    first.repartition(2).write.parquet(src)
    out1 = run_stream_completion(spark, src, events.schema, sink, ckpt, "user_id", failed)
    assert sorted(map(tuple, out1.collect())) == \
        sorted(map(tuple, completion_counts(first, "user_id", failed).collect()))
    # new files arrive; the restarted query reads only them and keeps its state
    second.repartition(2).write.mode("append").parquet(src)
    out2 = run_stream_completion(spark, src, events.schema, sink, ckpt, "user_id", failed)
    assert sorted(map(tuple, out2.collect())) == \
        sorted(map(tuple, completion_counts(events, "user_id", failed).collect()))
