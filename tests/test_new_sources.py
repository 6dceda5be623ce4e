"""Log sections by byte ranges, queue trees, site layers, adapters."""

import gzip
import json
import os
import random

import pytest

from fleetlens.operators import apps as A
from fleetlens.operators import config as C
from fleetlens.operators import resources as R
from fleetlens.sources import envelopes as E
from fleetlens.sources import files as SF
from fleetlens.sources import log_ranges as LR
from fleetlens.sources import logs as L
from fleetlens.sources import queues as Q
from fleetlens.sources import rest


def section(i, content, node="host_1:45454"):
    return (f"Container: container_1_0001_01_{i:06d} on {node}\nLogType:stderr\nLogLength:1\nLog Contents:\nerr {i}\n"
            f"LogType:stdout\nLogLength:9\nLog Contents:\n{content}\n")


def log_text(n, seed=1):
    rng = random.Random(seed)
    fill = ["Container: - not a header", "Container: container_1 on", " Container: a on b", "é日本🙂", "", "x" * 300, "LogLength:3"]
    return "before the first header\n" + "".join(
        section(i, "\n".join(rng.choices(fill, k=rng.randrange(1, 9)))) for i in range(n))


def all_sections(path, step, read_bytes, monkeypatch):
    monkeypatch.setattr(LR, "READ_BYTES", read_bytes)
    size = os.path.getsize(path)
    return [x for s in range(0, size, step) for x in LR.sections(path, s, min(s + step, size))]


@pytest.mark.parametrize("read_bytes", [5, 64, 1 << 20])
@pytest.mark.parametrize("step", [1, 37, 1000, 1 << 20])
def test_sections_of_any_ranges_tile_the_file(tmp_path, monkeypatch, step, read_bytes):
    if step == 1 and read_bytes == 5:
        pytest.skip("slow and covered by its neighbours")
    path = tmp_path / "app.log"
    path.write_bytes(log_text(12).encode())
    data = path.read_bytes()
    got = all_sections(str(path), step, read_bytes, monkeypatch)
    assert len(got) == 12 and got[0][0] == data.index(b"Container: ")
    assert b"".join(x for _, x in got) == data[got[0][0]:]
    for offset, x in got:
        assert data[offset:offset + len(x)] == x and x.startswith(b"Container: container_1_0001_01_")


def test_a_section_across_many_ranges_and_a_header_at_a_range_start(tmp_path, monkeypatch):
    path = tmp_path / "app.log"
    text = section(1, "y" * 50_000) + section(2, "z")
    path.write_text(text)
    second = text.index("Container: container_1_0001_01_000002")
    for step in (second, second - 1, second + 1, 100):
        got = all_sections(str(path), step, 64, monkeypatch)
        assert [o for o, _ in got] == [0, second]
    assert list(LR.sections(str(path), 1, second)) == []
    path.write_text("no header at all\n" * 50)
    assert all_sections(str(path), 100, 64, monkeypatch) == []


def test_offsets_read_back_through_spark(spark, tmp_path):
    folder = tmp_path / "logs"
    (folder / "app2").mkdir(parents=True)
    (folder / "a.log").write_text(log_text(40, 2))
    (folder / "app2" / "b.log").write_text(log_text(3, 3).replace("\n", "\r\n"))
    (folder / "_SUCCESS").write_text(section(9, "never"))
    (folder / "empty.log").write_text("")
    df = LR.read_log_ranges(spark, str(folder), range_bytes=500)
    rows = df.collect()
    assert len(rows) == 43 and df.rdd.getNumPartitions() > 10
    for r in rows:
        with open(r.file, "rb") as f:
            f.seek(r.offset)
            assert f.read(r.length).decode().replace("\r\n", "\n").removesuffix("\n") == r.value
    # the same sections as the reader that goes through Spark's text source
    plain = L.read_container_logs(spark, str(folder / "a.log"), with_file=False).collect()
    mine = LR.read_logs_with_offsets(spark, str(folder / "a.log"), 700).drop("file", "offset", "length").collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, mine)) and len(mine) == 80


def test_compressed_files_are_one_range(spark, tmp_path):
    text = log_text(8, 4)
    with gzip.open(tmp_path / "a.log.gz", "wt") as f:
        f.write(text)
    df = LR.read_log_ranges(spark, str(tmp_path), range_bytes=50)
    assert df.rdd.getNumPartitions() == 1
    for r in df.collect():
        assert text.encode()[r.offset:r.offset + r.length].decode().removesuffix("\n") == r.value
    assert df.count() == 8


def test_missing_folder_is_an_error(spark):
    with pytest.raises(Exception, match="nowhere"):
        LR.read_log_ranges(spark, "/tmp/nowhere-at-all").collect()


# --- queues ---------------------------------------------------------------------

def scheduler(root):
    return json.dumps({"scheduler": {"schedulerInfo": root}})


def test_queues_at_any_depth(spark):
    chain = {"queueName": "deep30"}
    for i in range(29, -1, -1):
        chain = {"queueName": f"deep{i}", "queues": {"queue": [chain]}}
    root = {"queueName": "root", "capacity": 100.0, "type": "capacityScheduler", "queues": {"queue": [
        {"queueName": "a", "capacity": 60, "usedCapacity": 1.5, "maxCapacity": 100, "numApplications": 3, "state": "RUNNING"},
        {"capacity": "odd", "queues": {"queue": {"queueName": "single"}}}, 7, None, chain]}}
    bodies = [(1, scheduler(root)), (2, "not json"), (3, "{}"), (4, scheduler(None)), (5, None),
              (6, scheduler({"queueName": "root", "queues": None})), (7, scheduler({"queueName": "root", "queues": {"queue": []}}))]
    df = spark.createDataFrame(bodies, "id long, body string")
    rows = Q.queue_tree(df, keep=("id",)).collect()
    by = {(r.id, r.path): r for r in rows}
    assert len(rows) == len(by) == 1 + 3 + 1 + 30 + 2
    a = by[1, "root.a"]
    assert (a.depth, a.queue, a.state, a.capacity, a.used_capacity, a.max_capacity, a.n_apps) == (1, "a", "RUNNING", 60.0, 1.5, 100.0, 3)
    nameless = by[1, "root."]
    assert (nameless.queue, nameless.capacity) == (None, None)
    assert by[1, "root..single"].depth == 2
    assert by[1, "root." + ".".join(f"deep{i}" for i in range(31))].depth == 31
    assert by[6, "root"].depth == by[7, "root"].depth == 0
    assert Q.queue_tree(df.limit(0)).collect() == []


# --- site files -----------------------------------------------------------------

def site(*pairs):
    rows = "".join(f"<property><name>{k}</name><value>{v}</value></property>\n" for k, v in pairs)
    return f"<configuration>\n{rows}</configuration>\n"


def test_later_property_and_later_file_override(spark, tmp_path):
    (tmp_path / "yarn-site.xml").write_text(site(("dfs.replication", "9"), ("k", "1"), ("k", "2"), ("only", "y"),
                                                 *[("many", str(i)) for i in range(2000)]))
    (tmp_path / "core-site.xml").write_text(site(("dfs.replication", "10"), ("dfs.replication", "4"), ("k", "0")))
    (tmp_path / "other-site.xml").write_text(site(("k", "other"), ("rest", "r")))
    rows = SF.read_site_layers(spark, str(tmp_path))
    won = {r.key: (r.layer, r.value) for r in C.resolve_layers(rows).collect()}
    assert won == {"dfs.replication": ("core-site", "4"), "k": ("core-site", "0"), "only": ("yarn-site", "y"),
                   "many": ("yarn-site", "1999"), "rest": (None, "r")}
    turned = SF.read_site_layers(spark, str(tmp_path), order=("core-site", "yarn-site"))
    assert {r.key: r.value for r in C.resolve_layers(turned).collect()}["k"] == "2"


def test_order_holds_in_a_long_file(spark, tmp_path):
    (tmp_path / "yarn-site.xml").write_text(site(*[(f"k{i % 3}", str(i)) for i in range(9000)]))
    rows = SF.read_site_layers(spark, str(tmp_path)).repartition(7)
    assert {r.key: r.value for r in C.resolve_layers(rows).collect()} == {"k0": "8997", "k1": "8998", "k2": "8999"}


def test_the_last_value_of_a_repeated_key_is_derived(spark):
    nodes = spark.createDataFrame([(1,), (2,)], "node_id long")
    raw = [(1, "dfs.replication", "9", 0, 1), (1, "dfs.replication", "10", 0, 0), (2, "dfs.replication", "9", 0, 0),
           (2, "dfs.replication", "10", 1, 0)]
    df = spark.createDataFrame(raw, "cluster_key long, key string, value string, priority int, seq int")
    assert {r.node_id: r.replication_factor for r in C.derive_parameters(df, nodes).collect()} == {1: 9, 2: 10}
    # no order is known: the greatest number
    assert {r.node_id: r.replication_factor for r in C.derive_parameters(df.drop("priority", "seq"), nodes).collect()} == {1: 10, 2: 10}


# --- adapters and bodies ----------------------------------------------------------

def test_captured_nodes_and_containers_reach_the_operators(spark):
    bodies = spark.createDataFrame([
        (7, '{"nodes": {"node": [{"id": "h1:1", "state": "RUNNING", "availMemoryMB": 4096, "availableVirtualCores": 4}, '
            '{"id": "h2:1", "state": "LOST", "availMemoryMB": 90000, "availableVirtualCores": 64}]}}'),
        (8, '{"nodes": null}')], "cluster_id long, body string")
    requests = spark.createDataFrame([(1, 7, 1, 2048, 2), (2, 7, 1, 5000, 8), (3, 8, 1, 1, 1)],
                                     "request_id long, cluster_id long, num_containers int, memory_mb int, vcores int")
    got = {r.request_id: r.decision for r in R.admission_check(requests, rest.admission_nodes(bodies)).collect()}
    assert got == {1: "OK", 2: "MEMORY", 3: "NO_NODES"}
    items = [{"id": f"container_1_0007_01_00000{i}", "nodeId": "n", "state": s, "exitCode": x}
             for i, s, x in ((1, "COMPLETE", 0), (2, "COMPLETE", 137), (3, "COMPLETE", None))]
    df = spark.createDataFrame([(json.dumps({"containers": {"container": items}}),)], "body string")
    [r] = A.completion_summary(rest.completion_containers(df)).collect()
    assert tuple(r) == ("application_1_0007", 3, 3, 1, "FAILED")


def test_only_one_json_value_alone_is_json(spark):
    odd = ['{"a":1} tail}', '{"a":1}}', "[1] , [2]", "[1]]", "1, 2", '1,"w":2', "", " ", "{} {}", '{"a":1}]', "1}"]
    fine = ['{"a":1}', " [1, 2]\n", "7", '"x"', "null", "true", '{"RemoteException": {"message": "m"}}', "[]", "{}"]
    df = spark.createDataFrame([(b,) for b in odd + fine], "body string")
    got = [r.status for r in E.split_error_responses(df).collect()]
    assert got[:len(odd)] == ["not_json"] * len(odd)
    assert got[len(odd):] == ["remote" if "Remote" in b else "unknown" for b in fine]
