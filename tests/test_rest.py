"""Typed readers for captured resource-manager responses."""


from fleetlens.operators import apps as A
from fleetlens.sources import rest

APP = ('{"id": "application_1700000000123_0042", "name": "nightly", "state": "ACCEPTED", '
       '"finalStatus": "UNDEFINED", "user": "ops", "queue": "batch", "progress": 0.0, '
       '"runningContainers": 2, "allocatedMB": 2048, "allocatedVCores": 2, '
       '"startedTime": 1700000100000, "finishedTime": 0, "elapsedTime": 5000, '
       '"memorySeconds": 10240, "vcoreSeconds": 10, "clusterId": 1700000000123, '
       '"amHostHttpAddress": "worker-3.example:8042", "diagnostics": "", "extraField": 5}')


def test_applications(spark):
    bodies = [(f'{{"apps": {{"app": [{APP}]}}}}',), ('{"apps": null}',), ("not json",)]
    df = spark.createDataFrame(bodies, "body string")
    rows = rest.applications(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.id, r.name, r.state, r.allocatedMB, r.clusterId) == \
        ("application_1700000000123_0042", "nightly", "ACCEPTED", 2048, 1700000000123)
    assert r.finished is None
    assert r.started is not None
    assert [x.app_id for x in A.select_killable(rest.applications(df).withColumnRenamed("id", "app_id"),
                                                name="nightly").collect()] == ["application_1700000000123_0042"]


def test_attempts_containers_nodes(spark):
    df = spark.createDataFrame([
        ('{"appAttempts": {"appAttempt": [{"id": 1, "startTime": 5, "containerId": "c1", "nodeId": "n:1"}]}}',),
        ('{"somethingElse": {}}',),
        ('{"containers": {"container": [{"id": "container_1_0001_01_000001", "nodeId": "n1", '
         '"state": "RUNNING", "containerLogsLink": "http://n1/logs"}]}}',),
        ('{"containers": {"container": []}}',),
        ('{"nodes": {"node": [{"nodeHostName": "h1", "availMemoryMB": 2048, "availableVirtualCores": 4}, '
         '{"nodeHostName": "h2", "availMemoryMB": 1024, "availableVirtualCores": 2}]}}',),
        ('{"clusterMetrics": {"activeNodes": 2, "availableMB": 3072, "availableVirtualCores": 6}}',),
        ('{"appStatInfo": {"statItem": [{"state": "RUNNING", "type": "*", "count": 3}]}}',),
    ], "body string")
    assert [(r.id, r.containerId) for r in rest.app_attempts(df).collect()] == [(1, "c1")]
    assert [r.state for r in rest.containers(df).collect()] == ["RUNNING"]
    assert sorted(r.availMemoryMB for r in rest.nodes(df).collect()) == [1024, 2048]
    m = rest.cluster_metrics(df).collect()
    assert [(x.activeNodes, x.availableMB, x.availableVirtualCores) for x in m] == [(2, 3072, 6)]
    assert [(x.state, x["count"]) for x in rest.app_statistics(df).collect()] == [("RUNNING", 3)]


def test_read_responses_from_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"nodes": {"node": [{"nodeHostName": "h1"}]}}\n'
                                      '{"nodes": {"node": [{"nodeHostName": "h2"}]}}\n')
    df = rest.read_responses(spark, str(tmp_path))
    assert sorted(r.nodeHostName for r in rest.nodes(df).collect()) == ["h1", "h2"]


def test_epoch_milliseconds_and_unset_times(spark):
    import datetime as dt

    df = spark.createDataFrame([('{"appAttempts": {"appAttempt": [{"id": 2, "startTime": 1700000000123, '
                                 '"finishedTime": 0}]}}',)], "body string")
    r = rest.app_attempts(df).select(
        "id", rest.epoch_ms("startTime").cast("timestamp_ntz").alias("s"), "finished").collect()[0]
    assert r.id == 2 and r.finished is None
    assert r.s == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)   # session time zone UTC
