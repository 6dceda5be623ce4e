"""Barrier runs, many needles, hot fingerprints, malformed ids."""

import hashlib
import random
import sys

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fleetlens.operators import apps as A
from fleetlens.operators import files as FL
from fleetlens.operators.barrier import run_in_tasks, run_status, shell
from fleetlens.plans import catalog


def test_tasks_run_at_once_and_one_failure_is_reported(spark):
    def words(batches, task):
        n = sum(len(b) for b in batches)
        told = task.allGather(str(n))
        print(f"{n} of {sum(map(int, told))}")
        if task.partitionId() == 2:
            raise ValueError("this one fails")
        return 4 if task.partitionId() == 3 else None

    df = spark.range(90).withColumn("x", F.lit("text"))
    out = run_in_tasks(df, words, 4, F.when(F.col("id") < 30, 0).when(F.col("id") < 60, 2).otherwise(3))
    rows = {r.task: r for r in out.collect()}
    assert {t: r.output for t, r in rows.items()} == {0: "30 of 90\n", 1: "0 of 90\n", 2: "30 of 90\n", 3: "30 of 90\n"}
    assert {t: (r.exit_status, r.error) for t, r in rows.items()} == {
        0: (0, None), 1: (0, None), 2: (1, "ValueError: this one fails"), 3: (4, None)}
    assert {(r.n_tasks, r.attempt) for r in rows.values()} == {(4, 0)}
    [s] = run_status(out).collect()
    assert tuple(s) == (4, 4, 2, "FAILED")


def test_a_command_in_each_task(spark):
    code = "import sys; print('out'); sys.stderr.write('oops'); sys.exit(7)"
    out = run_in_tasks(spark.range(5), shell([sys.executable, "-c", code]), 3, F.col("id") % 3)
    assert sorted((r.task, r.exit_status, r.output, r.error) for r in out.collect()) == [
        (i, 7, "out\n", "oops") for i in range(3)]
    fine = run_in_tasks(spark.range(0), shell([sys.executable, "-c", "print('final')"]), 2, F.lit(0))
    assert sorted((r.task, r.exit_status, r.output, r.error) for r in fine.collect()) == [(i, 0, "final\n", None) for i in (0, 1)]
    assert [r.final_status for r in run_status(fine).collect()] == ["UNDEFINED"]


# --- many needles -----------------------------------------------------------------

def test_many_needles_equal_one_at_a_time(spark):
    rng = random.Random(4)
    alphabet = "ab\né🙂"
    rows = [(f"c{i}", "stdout", "".join(rng.choices(alphabet, k=rng.randrange(60)))) for i in range(60)]
    rows += [("none", "stderr", None), ("empty", "stderr", ""), (None, None, "ab\nab")]
    df = spark.createDataFrame(rows, "container_id string, log_type string, content string")
    needles = ["a", "ab", "aba", "b", "🙂", "é🙂", "bbbbbbbbbbbbbb", "a"]
    got = sorted(map(tuple, A.search_many(df, needles).collect()), key=str)
    want = [(c, k, n, sum(n in line for line in t.split("\n"))) for c, k, t in rows if t for n in dict.fromkeys(needles)]
    assert got == sorted((w for w in want if w[3]), key=str)
    one = A.search_logs(df.filter("content IS NOT NULL"), "ab").collect()
    assert {(r.container_id, r.n_lines) for r in one} == {(c, n) for c, _, x, n in got if x == "ab"}


@pytest.mark.parametrize("needles", [[], [""], ["a\nb"]])
def test_needles_that_no_line_can_hold(spark, needles):
    df = spark.createDataFrame([], "container_id string, log_type string, content string")
    with pytest.raises(ValueError):
        A.search_many(df, needles)


# --- fingerprints -----------------------------------------------------------------

def test_hot_group_is_hashed_from_chunks(spark):
    hot = spark.range(60_000).select(F.lit("hot").alias("g"), F.concat(F.lit("pkg"), F.col("id") % 50_000).alias("i"))
    cold = spark.range(90_000).select(F.concat(F.lit("g"), F.col("id") % 500).alias("g"), F.concat(F.lit("é"), F.col("id")).alias("i"))
    odd = spark.createDataFrame([("null only", None), ("", "x"), (None, "y"), (None, None), ("hot", None), ("empty", "")], "g string, i string")
    got = {r.g: r.fp for r in FL.set_fingerprint(hot.unionByName(cold).unionByName(odd), "g", "i").collect()}

    def sha(items):
        return hashlib.sha1("-".join(sorted(items, key=str.encode)).encode()).hexdigest()

    assert got["hot"] == sha({f"pkg{i}" for i in range(50_000)})
    assert all(got[f"g{k}"] == sha({f"é{i}" for i in range(k, 90_000, 500)}) for k in range(0, 500, 50))
    assert (got["null only"], got[""], got[None], got["empty"]) == (sha([]), sha(["x"]), sha(["y"]), sha([""]))
    assert len(got) == 505


# --- malformed ids ----------------------------------------------------------------

IDS = ["container_1_0001_01_000001", "container_1_0001_01_000002", "container_e5_1_0002_01_000001", "bad-1", "bad-1", None,
       "container_1_0001_01", "container_1_0001_01_x", "", "container_e_1_0001_01_000001"]


def test_malformed_ids_belong_to_no_application(spark):
    df = spark.createDataFrame([(c, 1, 0) for c in IDS], "container_id string, completed int, exit_status int")
    seen = Observation("rejects")
    rows = A.completion_summary(df, observed=seen).collect()
    assert {r.app_id: r.requested for r in rows} == {"application_1_0001": 2, "application_1_0002": 1}
    assert seen.get == {"n_rows": 10, "n_malformed": 7}
    assert {r.app_id for r in A.used_containers(df).collect()} == {"application_1_0001", "application_1_0002"}
    workers = A.worker_containers(df).collect()
    assert [tuple(r) for r in workers] == [("container_1_0001_01_000002", "application_1_0001")]
    assert {r.app_id for r in A.latest_attempt_containers(df).collect()} == {"application_1_0001", "application_1_0002"}
    rejected = {r.container_id: (r.n, r.reason) for r in A.malformed(df).collect()}
    assert rejected == {"bad-1": (2, "prefix"), None: (1, "null"), "container_1_0001_01": (1, "parts"),
                        "container_1_0001_01_x": (1, "form"), "": (1, "prefix"), "container_e_1_0001_01_000001": (1, "form")}
    assert A.malformed(df.limit(0)).collect() == [] and A.completion_summary(df.limit(0)).collect() == []


def test_barrier_tasks_read_counts_instead_of_texts(spark, tmp_path, monkeypatch):
    texts = ["a b", None, "", "c\td e\u00a0f", "g", "h i j"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {}

    def watched(df, *more):
        got["columns"] = df.columns
        return run_in_tasks(df, *more)

    monkeypatch.setattr(catalog, "run_in_tasks", watched)
    rows = {r.task: (r.exit_status, r.output, r.error, r.failed, r.final_status)
            for r in catalog.barrier_run(spark, str(tmp_path)).collect()}
    assert got["columns"] == ["doc_id", "n_words"]
    assert rows == {t: (3 * (n % 2), f"{d} documents, {n} words", None, 3, "FAILED")
                    for t, d, n in ((0, 2, 3), (1, 2, 3), (2, 1, 0), (3, 1, 3))}
