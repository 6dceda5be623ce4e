"""Hot keys: one application holding a third of all rows.

Results must equal a brute-force computation, and the operators that
promise to split a hot key must really spread it over several groups.
"""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.operators import apps as A
from fleetlens.operators import resources as R

T0 = dt.datetime(2024, 1, 1)


def _skewed_events(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        app = 1 if i % 3 == 0 else rnd.randrange(2, 60)
        ts = T0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 24 * 3600))
        state = rnd.choice(["RUNNING", "FAILED", "SUBMITTED", "FINISHED"])
        rows.append((i, app, ts, state))
    return rows, spark.createDataFrame(rows, "event_id long, app_id long, ts timestamp_ntz, state string")


def test_pool_size_hot_app_equals_plain_window(spark):
    rows, ev = _skewed_events(spark, n=6000)
    got = {r.event_id: (r.requested, r.net) for r in A.pool_size_over_time(ev).collect()}
    w = Window.partitionBy("app_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    brute = ev.select(
        "event_id",
        F.sum(F.when(F.col("state") == "FAILED", 0).otherwise(1)).over(w).alias("requested"),
        F.sum(F.when(F.col("state") == "FAILED", -1).otherwise(1)).over(w).alias("net"))
    assert got == {r.event_id: (r.requested, r.net) for r in brute.collect()}
    assert got == {r.event_id: (r.requested, r.net) for r in
                   A.pool_size_over_time(ev, bucket=F.date_trunc("hour", "ts")).collect()}


def test_worker_containers_hot_app(spark):
    rnd = random.Random(3)
    ids = [f"container_1_{(1 if i % 3 == 0 else rnd.randrange(2, 40)):04d}_01_{i:06d}" for i in range(1, 3001)]
    df = spark.createDataFrame([(c, 0, 0) for c in ids], "container_id string, completed int, exit_status int")
    got = sorted(r.container_id for r in A.worker_containers(df).collect())
    first = {}
    for c in ids:
        app = c.split("_")[2]
        first[app] = min(first.get(app, c), c)
    assert got == sorted(c for c in ids if c not in set(first.values()))


def _brute_admission(reqs, nodes, strict):
    out = {}
    for rid, cl, n, mem, vc in reqs:
        ns = [x for x in nodes if x[1] == cl]
        if len(ns) < 1:
            out[rid] = "NO_NODES"
        elif sum(x[2] for x in ns) < max(300, 1024) + n * max(mem, 1024):
            out[rid] = "MEMORY"
        elif sum(x[3] for x in ns) < 1 + n * vc:
            out[rid] = "VCORES"
        elif all(((max(1024, mem) > x[2]) or (vc > x[3])) if strict else
                 ((max(1024, mem) > x[2]) and (vc > x[3])) for x in ns):
            out[rid] = "NO_NODE_FITS"
        else:
            out[rid] = "OK"
    return out


def test_admission_matches_per_node_test_on_a_hot_cluster(spark):
    rnd = random.Random(11)
    nodes = [(i, 0 if i % 3 == 0 else rnd.randrange(1, 8), rnd.randrange(0, 9000), rnd.randrange(0, 17))
             for i in range(600)]
    reqs = [(i, rnd.randrange(0, 9), rnd.randrange(1, 4), rnd.randrange(0, 12000), rnd.randrange(1, 21))
            for i in range(800)]
    n = spark.createDataFrame(nodes, "node_id long, cluster_id int, avail_mb int, avail_vcores int")
    r = spark.createDataFrame(reqs, "request_id long, cluster_id int, num_containers int, memory_mb int, vcores int")
    for strict in (False, True):
        got = {x.request_id: x.decision for x in R.admission_check(r, n, strict=strict).collect()}
        assert got == _brute_admission(reqs, nodes, strict)
        assert "BroadcastNestedLoopJoin" not in R.admission_check(r, n, strict=strict) \
            ._jdf.queryExecution().executedPlan().toString()


def test_latest_state_hot_app(spark):
    rows, ev = _skewed_events(spark, seed=5)
    universe = spark.createDataFrame([(a,) for a in range(0, 61)], "app_id long")
    got = {r.app_id: r.state for r in A.latest_state(ev, universe).collect()}
    best = {}
    for eid, app, ts, st in rows:
        if app not in best or (ts, eid) > best[app][0]:
            best[app] = ((ts, eid), st)
    assert got == {a: (best[a][1] if a in best else "NONE") for a in range(0, 61)}


def test_worker_containers_string_order_on_mixed_id_forms(spark):
    ids = ["container_17_0001_01_000002", "container_17_0001_01_000005",
           "container_17_0001_01_1000000",          # 7 digits: smallest as a string
           "container_17_0002_02_000001", "container_17_0002_01_000009",
           "container_e3_17_0003_01_000001", "container_17_0003_01_000002",
           "container_17_0004_10_000010", "container_17_0004_09_999999"]
    df = spark.createDataFrame([(c, 0, 0) for c in ids], "container_id string, completed int, exit_status int")
    want = {}
    for c in ids:
        parts = c.split("_")
        app = "application_" + "_".join(parts[-4:-2])
        want[app] = min(want.get(app, c), c)
    workers = sorted(r.container_id for r in A.worker_containers(df).collect())
    assert workers == sorted(c for c in ids if c not in set(want.values()))
