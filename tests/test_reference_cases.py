"""Cases of the kinds the reference tests (address parsing, derived parameters,
URI form), as table rows through our operators."""

from pyspark.sql import functions as F

from fleetlens.operators import config as C
from fleetlens.operators import files as FL


def test_host_port_forms(spark):
    df = spark.createDataFrame(
        [("hdfs://rm7.lab.example:9188",), ("rm7.lab.example:9188",), ("rm7.lab.example",),
         ("HTTP://Rm7.Lab.example/x",), ("http://user:pw@[::1]:9000/p",)], "addr string")
    got = {r.addr: (r.host, r.port) for r in C.host_port(df, "addr").collect()}
    assert got["hdfs://rm7.lab.example:9188"] == ("rm7.lab.example", 9188)
    assert got["rm7.lab.example:9188"] == ("rm7.lab.example", 9188)
    assert got["rm7.lab.example"] == ("rm7.lab.example", None)
    assert got["HTTP://Rm7.Lab.example/x"] == ("rm7.lab.example", None)
    assert got["http://user:pw@[::1]:9000/p"] == ("::1", 9000)


def _derive(spark, pairs):
    raw = spark.createDataFrame([(1, k, v) for k, v in pairs] or [(1, "x", "y")],
                                "cluster_key long, key string, value string")
    universe = spark.createDataFrame([(1,)], "node_id long")
    return C.derive_parameters(raw, universe).collect()[0]


def test_derived_defaults(spark):
    r = _derive(spark, [])
    assert (r.rm, r.rm_port, r.rm_port_https, r.replication_factor) == ("localhost", 8088, 8090, 3)


def test_derived_replication(spark):
    assert _derive(spark, [("dfs.replication", "6")]).replication_factor == 6


def test_webapp_address_wins_and_gives_port(spark):
    r = _derive(spark, [("yarn.resourcemanager.webapp.address", "web-a.example:7443"),
                        ("yarn.resourcemanager.hostname", "host-b.example")])
    assert (r.rm, r.rm_port) == ("web-a.example", 7443)


def test_hostname_with_default_port(spark):
    r = _derive(spark, [("yarn.resourcemanager.hostname", "host-b.example")])
    assert (r.rm, r.rm_port) == ("host-b.example", 8088)


def test_https_port(spark):
    r = _derive(spark, [("yarn.resourcemanager.webapp.https.address", "tls.example:7444")])
    assert r.rm_port_https == 7444


def test_address_without_port_leaves_port_null(spark):
    r = _derive(spark, [("yarn.resourcemanager.webapp.address", "noport.com")])
    assert (r.rm, r.rm_port) == ("noport.com", None)


def test_universe_member_without_config_gets_defaults(spark):
    raw = spark.createDataFrame([(1, "dfs.replication", "2")], "cluster_key long, key string, value string")
    universe = spark.createDataFrame([(1,), (2,)], "node_id long")
    got = {r.node_id: r.replication_factor for r in C.derive_parameters(raw, universe).collect()}
    assert got == {1: 2, 2: 3}


def test_triple_slash(spark):
    df = spark.createDataFrame([("hdfs://jobs/part-0",), ("hdfs:///jobs/part-0",),
                                ("hdfs:////jobs/part-0",), ("hdfs://nn:8020/p",),
                                ("s3a://b/k",), ("/local/dir/env.zip",)], "uri string")
    out = [r.u for r in df.select(FL.normalize_uri(F.col("uri")).alias("u")).collect()]
    assert out == ["hdfs:///jobs/part-0", "hdfs:///jobs/part-0", "hdfs:////jobs/part-0",
                   "hdfs:///nn:8020/p", "s3a://b/k", "file:/local/dir/env.zip"]
    staged = [r.u for r in df.select(FL.normalize_uri(F.col("uri"), "hdfs:///user/me/.staging")
                                     .alias("u")).collect()]
    assert staged[-1] == "hdfs:///user/me/.staging/env.zip"


def test_layers_override_in_order(spark):
    rows = [(0, "yarn", "a", 1, "y1"), (1, "core", "a", 2, "c1"), (3, "kwargs", "a", 3, "k1"),
            (2, "pars", "a", 4, "p1"), (0, "yarn", "b", 5, "y2"), (0, "yarn", "b", 6, "y3")]
    df = spark.createDataFrame(rows, "priority int, layer string, key string, seq long, value string")
    got = {r.key: (r.layer, r.value) for r in C.resolve_layers(df).collect()}
    assert got == {"a": ("kwargs", "k1"), "b": ("yarn", "y3")}
