"""Tests that need their own process.

A lost worker mid-task: Spark retries the task and the result is whole (the
session allows task retries, ``local[2,3]``: two threads, three attempts per
task). The command line runs a query and writes its result. A session that
names ``spark.checkpoint.dir`` gets its scratch data and checkpoints there.
"""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import types as T
from fleetlens.session import build_session
from fleetlens.operators.udf import map_partitions_with_outcome

spark = build_session(master="local[2,3]", shuffle_partitions=4)
marker = {marker!r}

def fn(x):
    if x == 7 and not os.path.exists(marker):
        open(marker, "w").close()
        os._exit(1)          # the Python worker dies in the middle of a task
    return x * 2

df = spark.range(40).withColumnRenamed("id", "x")
out = map_partitions_with_outcome(df, fn, "x", T.LongType(), keep=("x",), num_partitions=4)
rows = sorted((r.x, r.status, r.result) for r in out.collect())
assert rows == [(i, "ok", 2 * i) for i in range(40)], rows
assert os.path.exists(marker)
print("RETRIED-OK")
"""


def test_task_is_retried_after_worker_loss(tmp_path):
    code = SCRIPT.format(root=ROOT, marker=str(tmp_path / "crashed"))
    res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "RETRIED-OK" in res.stdout, res.stderr[-2000:]


def test_command_line_runs_a_query(tmp_path):
    out = tmp_path / "out"
    res = subprocess.run([sys.executable, "-m", "fleetlens", "run", "state_counts",
                          "--data", "/root/testdata/sf0.001", "--out", str(out), "--format", "json"],
                         cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    import json

    rows = [json.loads(ln) for f in out.glob("part-*.json") for ln in f.read_text().splitlines()]
    assert sum(r["n"] for r in rows) == 1500   # orders at sf0.001
    listed = subprocess.run([sys.executable, "-m", "fleetlens", "list"], cwd=ROOT,
                            capture_output=True, text=True, timeout=120)
    assert "app_progress" in listed.stdout.split()


CKPT_SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from fleetlens.session import build_session, checkpoint_root, materialize, scratch_path
shared = {shared!r}
spark = build_session(master="local[2]", extra={{"spark.checkpoint.dir": shared}})
assert checkpoint_root(spark) == shared, checkpoint_root(spark)
p = scratch_path(spark, "probe")
assert p.startswith(shared + "/probe-"), p
df = materialize(spark, spark.range(10))
assert df.count() == 10
written = [d for d, _, files in os.walk(shared) if any(f.startswith("part-") for f in files)]
assert written, "checkpoint files not under spark.checkpoint.dir"
print("CKPT-OK")
"""


def test_scratch_and_checkpoints_use_the_configured_folder(tmp_path):
    shared = str(tmp_path / "shared-ckpt")
    code = CKPT_SCRIPT.format(root=ROOT, shared=shared)
    res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "CKPT-OK" in res.stdout, res.stderr[-2000:]
