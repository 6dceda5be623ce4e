"""Plan shape and partition independence.

No query may pair rows of two inputs without a key (Cartesian product or
nested-loop join), or funnel all rows through one partition. Results must
not depend on the number of shuffle partitions.
"""

import pytest

import __spark_entry__ as entry
from fleetlens.plans.catalog import QUERIES
from conftest import SF_SMALL
from helpers import canon, spark_rows

# Queries that write derived files before reading them back; their plans are
# checked too, only the write step runs once more.
# A stateful stream ends before its result is read, and its state is bound to
# the number of partitions it started with; tests/test_final_status.py has them.
NAMES = sorted(set(QUERIES) - {"stream_final_status", "stream_deadlines"})
BAD_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition")


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_single_partition(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in BAD_NODES:
        assert bad not in plan, f"{name}: {bad} in plan"


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    df = entry.queries()["storage_need"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.split("\n") if "FileScan parquet" in ln][0]
    assert "ReadSchema: struct<doc_id:bigint,source:string,n_chars:bigint>" in scan

    from fleetlens.operators import resources as R

    path = str(tmp_path / "files")
    spark.createDataFrame([("hdfs://x/a", "app", 10, 1, "junk"), ("b", "app", 20, 2, "junk")],
                          "path string, app string, size long, mtime long, other string") \
        .write.parquet(path)
    plan = R.storage_need(spark.read.parquet(path), unit=1)._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.split("\n") if "FileScan parquet" in ln][0]
    assert "StringStartsWith(path,hdfs://)" in scan
    assert "other" not in scan.split("ReadSchema:")[1]


@pytest.mark.parametrize("name", NAMES)
def test_result_independent_of_partitions(spark, name):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(canon(*spark_rows(entry.queries()[name](spark, SF_SMALL))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


PYTHON_NODES = ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas",
                "MapInArrow", "PythonUDF")
PYTHON_ALLOWED = {"map_outcome", "set_fingerprint", "log_search_many"}


@pytest.mark.parametrize("name", NAMES)
def test_python_only_where_it_is_the_semantics(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    uses_python = any(n in plan for n in PYTHON_NODES)
    assert uses_python == (name in PYTHON_ALLOWED), name
