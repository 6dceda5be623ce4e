"""Property tests: exact results for any input and any bucketing."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.functions.running import running_sums
from fleetlens.operators import files as FL

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)

events = st.lists(
    st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 500)), st.integers(-3, 3)),
    min_size=0, max_size=60)


@SETTINGS
@given(rows=events, width=st.sampled_from([1, 7, 60, 100000]))
def test_running_sums_equal_plain_window(spark, rows, width):
    data = [(i, k, None if m is None else T0 + dt.timedelta(minutes=m), v) for i, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id long, k long, ts timestamp_ntz, v long")
    bucket = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(width * 60_000_000))
    got = {r.event_id: r.s for r in running_sums(df, ["k"], ["ts", "event_id"], {"s": F.col("v")}, bucket)
           .collect()}
    w = Window.partitionBy("k").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.event_id: r.s for r in df.select("event_id", F.sum("v").over(w).alias("s")).collect()}
    assert got == want


packages = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]),
                              st.text("xyz=-.0123", min_size=1, max_size=6)), max_size=40)


@SETTINGS
@given(rows=packages)
def test_fingerprint_equals_hashlib(spark, rows):
    df = spark.createDataFrame(rows, "env string, spec string")
    got = {r.env: r.fp for r in FL.set_fingerprint(df, "env", "spec").collect()}
    want = {}
    for env in {e for e, _ in rows}:
        items = sorted({s for e, s in rows if e == env})
        want[env] = hashlib.sha1("-".join(items).encode()).hexdigest()
    assert got == want
