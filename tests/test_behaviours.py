"""Behaviours kept from the reference and changed on purpose,
plus empty input, nulls and ties."""

import datetime as dt

from pyspark.sql import functions as F

from fleetlens.functions import ids
from fleetlens.operators import apps as A
from fleetlens.operators import files as FL
from fleetlens.operators import resources as R
from fleetlens.sources import logs as L


# --- container ids -----------------------------------------------------------

def test_epoch_container_ids_get_the_right_key(spark):
    df = spark.createDataFrame([("container_e17_1700000000123_0001_01_000001",),
                                ("container_1700000000123_0001_01_000002",),
                                ("not_an_id",)], "c string")
    out = df.select(ids.app_key(F.col("c")).alias("k"), ids.attempt(F.col("c")).alias("a")).collect()
    assert [r.k for r in out] == ["1700000000123_0001", "1700000000123_0001", None]
    assert [r.a for r in out] == [1, 1, None]


# --- log sections ----------------------------------------------------------

LOG = (
    "Container: container_1_0001_01_000001 on host-1.x_45454\n"
    "LogType:stderr\nLog Upload Time:Mon\nLogLength:5\nLog Contents:\nerr 1\n\n"
    "LogType:stdout\nLogLength:9\nLog Contents:\nline one\nline two\n\n"
    "LogType:syslog\nLog Contents:\nsys\n"
    "Container: container_1_0001_01_000002 on node_7\n"
    "LogType:stdout\nLog Contents:\nhello\n"
    "Container: container_1_0001_01_000001 on host-1.x_45454\n"
    "LogType:stdout\nLog Contents:\nagain\n")


def _write(tmp_path, text, name="log.txt"):
    p = tmp_path / name
    p.write_text(text)
    return str(tmp_path)


def test_log_sections(spark, tmp_path):
    rows = L.read_container_logs(spark, _write(tmp_path, LOG)).collect()
    got = sorted((r.container_id, r.node_id, r.log_type, r.content) for r in rows)
    assert got == sorted([
        ("container_1_0001_01_000001", "host", "stderr", "err 1"),
        ("container_1_0001_01_000001", "host", "stdout", "line one\nline two"),
        ("container_1_0001_01_000001", "host", "syslog", "sys"),
        ("container_1_0001_01_000002", "node_7", "stdout", "hello"),
        ("container_1_0001_01_000001", "host", "stdout", "again"),
    ])


def test_log_full_node_name(spark, tmp_path):
    rows = L.read_container_logs(spark, _write(tmp_path, LOG), full_node=True).collect()
    assert {r.node_id for r in rows} == {"host-1.x_45454", "node_7"}


def test_log_sections_survive_many_splits(spark, tmp_path):
    body = "".join(
        f"Container: container_1_0001_01_{i:06d} on n{i % 3}\nLogType:stdout\nLog Contents:\n"
        + ("x" * 50 + "\n") * 20 for i in range(300))
    path = _write(tmp_path, body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = L.read_container_logs(spark, path)
        assert df.rdd.getNumPartitions() > 10
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 300
    assert len({r.container_id for r in rows}) == 300
    assert all(r.content == "\n".join(["x" * 50] * 20) for r in rows)


def test_log_crlf_and_section_report(spark, tmp_path):
    text = LOG.replace("\n", "\r\n") + "Container: oops this is content\r\nmore\r\n"
    rows = L.read_container_logs(spark, _write(tmp_path, text)).collect()
    got = {(r.container_id, r.log_type, r.content) for r in rows}
    assert ("container_1_0001_01_000001", "stdout", "line one\nline two") in got
    assert ("container_1_0001_01_000001", "syslog", "sys") in got
    assert any(r.content.endswith("Container: oops this is content\nmore") for r in rows)
    rep = L.section_report(L.read_log_sections(spark, str(tmp_path))).collect()
    assert [(r.sections, r.unmatched) for r in rep] == [(3, 1)]


def test_log_unmatched_header_is_kept_on_request(spark):
    df = spark.createDataFrame([("Container: not a header\nLogType:stdout\nLog Contents:\nx",)], "value string")
    assert L.section_container_logs(df).count() == 0
    kept = L.section_container_logs(df, keep_unmatched=True).collect()
    assert len(kept) == 1 and kept[0].container_id is None


# --- log pages ---------------------------------------------------------------

PAGE = ('<html><table><tr><td class="content">\n          <pre>error: done here</pre>\n'
        '        </td></tr></table></html>')


def test_log_page_wrapper_only_is_stripped(spark):
    df = spark.createDataFrame([(PAGE,), ("<p>Cannot find this log on the node</p>",),
                                ("<html>no marker</html>",)], "html string")
    got = [r.content for r in L.extract_log_html(df).collect()]
    assert got == ["error: done here", "", ""]


def test_log_page_strict_chars_keeps_reference_stripping(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    got = L.extract_log_html(df, strict_chars=True).collect()[0].content
    assert got == "or: done h"


# --- admission -------------------------------------------------------------

def _admit(spark, reqs, nodes, strict=False):
    r = spark.createDataFrame(reqs, "request_id long, cluster_id int, num_containers int, memory_mb int, vcores int")
    n = spark.createDataFrame(nodes, "node_id long, cluster_id int, avail_mb int, avail_vcores int")
    return {x.request_id: x.decision for x in R.admission_check(r, n, strict=strict).collect()}


def test_admission_order_and_and_rule(spark):
    nodes = [(1, 1, 3000, 2), (2, 1, 500, 8), (3, 2, 100000, 64)]
    reqs = [(10, 1, 1, 2000, 4),   # node 1 short of vcores only, node 2 of memory only: fits (AND)
            (11, 9, 1, 100, 1),    # no nodes in cluster 9
            (12, 1, 5, 2000, 1),   # memory: 1024 + 5*2000 > 3500
            (13, 1, 1, 1024, 20),  # vcores: 1 + 20 > 10
            (14, 2, 1, 2048, 2)]
    got = _admit(spark, reqs, nodes)
    assert got == {10: "OK", 11: "NO_NODES", 12: "MEMORY", 13: "VCORES", 14: "OK"}
    strict = _admit(spark, reqs, nodes, strict=True)
    assert strict[10] == "NO_NODE_FITS" and strict[14] == "OK"


def test_admission_no_node_fits(spark):
    nodes = [(1, 1, 2000, 2), (2, 1, 2000, 2), (3, 1, 2000, 2)]
    got = _admit(spark, [(1, 1, 1, 2500, 3)], nodes)
    assert got == {1: "NO_NODE_FITS"}


# --- completion, progress, pool --------------------------------------------

def _containers(spark, rows):
    return spark.createDataFrame(rows, "container_id string, completed int, exit_status int")


def test_completion_and_progress(spark):
    c = _containers(spark, [
        ("container_1_0001_01_000001", 1, 0), ("container_1_0001_01_000002", 1, 1),
        ("container_1_0002_01_000001", 1, 0), ("container_1_0002_01_000002", 0, 0),
        ("container_1_0003_01_000001", 1, 0)])
    s = {r.app_id: r for r in A.completion_summary(c).collect()}
    assert s["application_1_0001"].final_status == "FAILED"
    assert s["application_1_0002"].final_status == "RUNNING"
    assert s["application_1_0003"].final_status == "UNDEFINED"
    p = {r.app_id: r.progress for r in A.progress(A.completion_summary(c)).collect()}
    assert abs(p["application_1_0003"] - (0.1 + 1 / 0.9)) < 1e-12   # about 1.211
    assert abs(p["application_1_0002"] - (0.1 + 1 / 1.8)) < 1e-12


def test_progress_with_nothing_requested(spark):
    s = spark.createDataFrame([("a", 0, 0)], "app_id string, requested long, completed long")
    assert A.progress(s).collect()[0].progress == 0.1


def test_worker_and_latest_attempt(spark):
    c = _containers(spark, [
        ("container_1_0001_01_000001", 1, 0), ("container_1_0001_01_000002", 0, 0),
        ("container_1_0001_02_000003", 0, 0), ("container_1_0001_02_000001", 0, 0),
        ("container_1_0002_01_000001", 0, 0)])
    w = sorted(r.container_id for r in A.worker_containers(c).collect())
    assert w == ["container_1_0001_01_000002", "container_1_0001_02_000001", "container_1_0001_02_000003"]
    la = {r.app_id: r.ids for r in A.latest_attempt_containers(c).collect()}
    assert la == {"application_1_0001": "container_1_0001_02_000001,container_1_0001_02_000003",
                  "application_1_0002": "container_1_0002_01_000001"}
    used = {r.app_id: r.n_used for r in A.used_containers(c).collect()}
    assert used == {"application_1_0001": 3, "application_1_0002": 1}


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, app_id long, ts timestamp_ntz, state string")


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def test_pool_size_removal_keeps_requested(spark):
    rows = [(1, 7, T0, "SUBMITTED"), (2, 7, T0 + dt.timedelta(hours=1), "RUNNING"),
            (3, 7, T0 + dt.timedelta(hours=3), "FAILED"), (4, 7, T0 + dt.timedelta(hours=3), "RUNNING"),
            (5, 8, None, "RUNNING"), (6, 8, T0, "FAILED")]
    out = {r.event_id: (r.requested, r.net) for r in A.pool_size_over_time(_events(spark, rows)).collect()}
    assert out == {1: (1, 1), 2: (2, 2), 3: (2, 1), 4: (3, 2), 5: (1, 1), 6: (1, 0)}


def test_time_to_terminal_and_latest_state(spark):
    rows = [(1, 1, T0, "SUBMITTED"), (2, 1, T0 + dt.timedelta(seconds=5), "FINISHED"),
            (3, 2, T0, "RUNNING"), (4, 3, T0, "RUNNING"), (5, 3, T0 + dt.timedelta(seconds=30), "KILLED"),
            (6, 4, T0, "RUNNING"), (7, 4, T0, "FAILED")]
    ev = _events(spark, rows)
    t = {r.app_id: (r.wait_us, r.in_time) for r in A.time_to_terminal(ev).collect()}
    assert t == {1: (5_000_000, True), 2: (None, False), 3: (30_000_000, False), 4: (0, True)}
    universe = spark.createDataFrame([(1,), (2,), (4,), (99,)], "app_id long")
    s = {r.app_id: r.state for r in A.latest_state(ev, universe).collect()}
    assert s == {1: "FINISHED", 2: "RUNNING", 4: "FAILED", 99: "NONE"}   # tie on ts: higher event_id


def test_select_killable(spark):
    apps = spark.createDataFrame([(1, "ops", "RUNNING"), (2, "ops", "FINISHED"), (3, "other", "RUNNING"),
                                  (4, "ops", None)], "app_id long, name string, state string")
    assert sorted(r.app_id for r in A.select_killable(apps, name="ops").collect()) == [1, 4]
    assert sorted(r.app_id for r in A.select_killable(apps).collect()) == [1, 3, 4]


# --- files and packages ------------------------------------------------------

def test_upload_delta_actions(spark):
    local = spark.createDataFrame([("a/x.zip", 10, 100), ("a/y.zip", 10, 100), ("a/z.zip", 10, 200),
                                   ("a/w.zip", 10, 100)], "path string, size long, mtime long")
    remote = spark.createDataFrame([("a/y.zip", 11, 300), ("a/z.zip", 10, 200), ("a/w.zip", 10, 101)],
                                   "path string, size long, last_mod long")
    got = {r.path: r.action for r in FL.upload_delta(local, remote).collect()}
    assert got == {"a/x.zip": "missing", "a/y.zip": "size", "a/z.zip": "stale", "a/w.zip": "skip"}
    assert {r.action for r in FL.upload_delta(local, remote, always=True).collect()} == {"upload"}


def test_first_by_key_user_pin_wins_and_scikit_shares_a_key(spark):
    df = spark.createDataFrame([("e", "numpy=1.2", 0), ("e", "scikit-learn", 1), ("e", "numpy", 5),
                                ("e", "scikit-image", 6)], "env string, spec string, pos long")
    got = {(r.key, r.spec) for r in FL.first_by_key(df, "env", "spec", "pos").collect()}
    assert got == {("numpy", "numpy=1.2"), ("scikit", "scikit-learn")}


def test_fingerprint_equals_hashlib(spark):
    import hashlib

    items = ["python=3", "numpy", "nomkl", "numpy"]
    df = spark.createDataFrame([("e", s) for s in items], "env string, spec string")
    want = hashlib.sha1("-".join(sorted(set(items))).encode()).hexdigest()
    assert FL.set_fingerprint(df, "env", "spec").collect()[0].fp == want


def test_empty_inputs(spark):
    c = _containers(spark, [])
    assert A.completion_summary(c).count() == 0
    assert A.worker_containers(c).count() == 0
    assert A.latest_attempt_containers(c).count() == 0


def test_fingerprint_streams_across_batches_and_groups(spark):
    import hashlib
    import random

    rnd = random.Random(7)
    rows = [(f"env{g}", f"pkg{rnd.randrange(40)}") for g in range(6) for _ in range(50)]
    rows += [(None, "a"), (None, "b"), ("env0", None)]
    df = spark.createDataFrame(rows, "env string, spec string")
    want = {}
    for g in {r[0] for r in rows}:
        items = sorted({s for e, s in rows if e == g and s is not None})
        want[g] = hashlib.sha1("-".join(items).encode()).hexdigest()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.env: r.fp for r in FL.set_fingerprint(df.repartition(3), "env", "spec").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == want


def test_storage_need_skips_remote_and_compares_capacity(spark):
    files = spark.createDataFrame([("a", "hdfs://nn/x.zip", 5 << 20), ("a", "/l/y.zip", 3 << 20),
                                   ("a", "/l/z.txt", (1 << 20) - 1), ("b", "/l/w.zip", 10 << 20)],
                                  "app string, path string, size long")
    cap = spark.createDataFrame([("a", 4), ("b", 9)], "app string, free long")
    got = {r.app: (r.need, r.fits) for r in R.storage_need(files, capacity=cap).collect()}
    assert got == {"a": (3, True), "b": (10, False)}


def test_cluster_conf_scales_with_cores():
    from fleetlens.session import cluster_conf

    conf = cluster_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")


def test_log_sections_from_gzip(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "app.log.gz", "wt") as f:
        f.write(LOG)
    rows = L.read_container_logs(spark, str(tmp_path)).collect()
    assert len(rows) == 5
    assert {r.content for r in rows} >= {"err 1", "line one\nline two", "hello", "again"}


def test_log_content_that_looks_like_a_header_is_kept(spark, tmp_path):
    def section(i):
        lines = [f"Container: exited with code {i}", "y" * (i % 7 * 40), "Container: - again", "end"]
        return (f"Container: container_1_0001_01_{i:06d} on n{i % 3}\nLogType:stderr\nLog Contents:\nbad\n"
                + "LogType:stdout\nLog Contents:\nfirst\n" + "\n".join(lines) + "\n"), "\n".join(["first", *lines])

    made = [section(i) for i in range(200)]
    path = _write(tmp_path, "Container: before any header\n" + "".join(s for s, _ in made))
    want = {(f"container_1_0001_01_{i:06d}", "stdout", made[i][1]) for i in range(200)}
    want |= {(f"container_1_0001_01_{i:06d}", "stderr", "bad") for i in range(200)}
    for size in ("4096", "256m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = L.read_container_logs(spark, path).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(rows) == 400
        assert {(r.container_id, r.log_type, r.content) for r in rows} == want


def test_fingerprint_of_long_keys_numbers_and_channels(spark):
    import hashlib

    big = 9007199254740993
    df = spark.createDataFrame(
        [(None, 1, False), (None, 2, False), (big, 3, False), (big, 10, None), (big, 3, True), (7, None, False)],
        "env long, spec int, is_channel boolean")

    def sha(text):
        return hashlib.sha1(text.encode()).hexdigest()

    got = FL.set_fingerprint(df, "env", "spec").collect()
    assert {(r.env, r.fp) for r in got} == {(None, sha("1-2")), (big, sha("10-3")), (7, sha(""))} and len(got) == 3
    got = FL.set_fingerprint(df, "env", "spec", channel="is_channel").collect()
    assert {(r.env, r.fp) for r in got} == {(None, sha("1-2")), (big, sha("10-3-3")), (7, sha(""))}


def test_app_progress_has_every_application(spark):
    from fleetlens.plans.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    got = QUERIES["app_progress"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/orders.parquet").count()
    assert got.filter("requested = 0 and progress <> 0.1").count() == 0
