"""Envelopes, error bodies, site XML and file listings."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators import config as C
from fleetlens.sources import envelopes as E
from fleetlens.sources import files as SF

ITEM = T.StructType([T.StructField("id", T.StringType()), T.StructField("state", T.StringType())])


def test_flatten_envelope_null_empty_and_bad(spark):
    bodies = [('{"apps": {"app": [{"id": "a1", "state": "RUNNING"}, {"id": "a2", "state": "FAILED"}]}}',),
              ('{"apps": null}',), ('{"apps": {"app": []}}',), ("{}",), ("<html>oops",),
              ('{"apps": {"app": [{"id": "a3", "state": "NEW"}]}}',)]
    df = spark.createDataFrame(bodies, "body string")
    got = sorted((r.id, r.state) for r in E.flatten_envelope(df, "body", "apps", "app", ITEM).collect())
    assert got == [("a1", "RUNNING"), ("a2", "FAILED"), ("a3", "NEW")]


def test_error_bodies(spark):
    bodies = ['{"RemoteException": {"message": "app not found", "exception": "NotFound"}}',
              '{"RemoteException": {"exception": "BadRequest"}}',
              "<html>Bad Gateway</html>",
              '{"something": 1}',
              "[1, 2]", '{"RemoteException": null}', "", '{"k']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [(r.status, r.message) for r in E.split_error_responses(df).collect()]
    assert got[0] == ("remote", "app not found")
    assert got[1][0] == "remote_other" and "BadRequest" in got[1][1]
    assert got[2] == ("not_json", "<html>Bad Gateway</html>")
    assert got[3] == ("unknown", None)
    assert got[4] == ("unknown", None) and got[5] == ("unknown", None)   # valid JSON, no exception
    assert got[6] == ("not_json", "") and got[7] == ("not_json", '{"k')


MULTI_LINE = """<?xml version="1.0"?>
<configuration>
  <!-- a comment with <name>ignored</name> inside -->
  <property>
    <name>fs.defaultFS</name>
    <value>hdfs://nn.example:8020</value>
  </property>
  <property>
    <name>dfs.replication</name>
    <value>2</value>
  </property>
  <property>
    <name>a.b</name>
    <value>x &amp; y</value>
  </property>
  <property><name>spaced</name><value> kept as written </value></property>
</configuration>
"""

ONE_PER_LINE = """<?xml version="1.0"?>
<configuration>
  <property><name>yarn.resourcemanager.webapp.address</name><value>rm-host:8088</value></property>
  <property><name>dfs.replication</name><value>5</value><final>true</final><source>programmatically</source></property>
</configuration>
"""


def test_site_config_reader(spark, tmp_path):
    (tmp_path / "core-site.xml").write_text(MULTI_LINE)
    (tmp_path / "yarn-site.xml").write_text(ONE_PER_LINE)
    (tmp_path / "notes.txt").write_text("not config")
    df = SF.read_site_config(spark, str(tmp_path))
    rows = {(r.file.rsplit("/", 1)[-1], r.key): r.value for r in df.collect()}
    assert rows == {("core-site.xml", "fs.defaultFS"): "hdfs://nn.example:8020",
                    ("core-site.xml", "dfs.replication"): "2",
                    ("core-site.xml", "a.b"): "x & y",
                    ("core-site.xml", "spaced"): " kept as written ",
                    ("yarn-site.xml", "yarn.resourcemanager.webapp.address"): "rm-host:8088",
                    ("yarn-site.xml", "dfs.replication"): "5"}
    extra = {r.key: (r.final, r.source) for r in df.filter(F.col("file").endswith("yarn-site.xml")).collect()}
    assert extra == {"yarn.resourcemanager.webapp.address": (None, None),
                     "dfs.replication": (True, "programmatically")}
    # later file (yarn after core) wins when layered
    layered = df.select(
        F.when(F.col("file").endswith("yarn-site.xml"), 1).otherwise(0).alias("priority"),
        F.col("file").alias("layer"), "key", F.lit(0).alias("seq"), "value")
    win = {r.key: r.value for r in C.resolve_layers(layered).collect()}
    assert win["dfs.replication"] == "5"


def test_file_listing_is_metadata_only(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.zip").write_bytes(b"x" * 10)
    (tmp_path / "sub" / "b.zip").write_bytes(b"y" * 20)
    (tmp_path / "c.txt").write_bytes(b"z")
    df = SF.list_files(spark, str(tmp_path), glob="*.zip")
    got = sorted((r.path.rsplit("/", 1)[-1], r.size) for r in df.collect())
    assert got == [("a.zip", 10), ("b.zip", 20)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    all_files = SF.filter_manifest(SF.list_files(spark, str(tmp_path)), ".txt")
    assert [r.size for r in all_files.collect()] == [1]


def test_manifest_queries_cover_all_documents(spark):
    from conftest import SF_SMALL
    from fleetlens.plans.catalog import QUERIES

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert QUERIES["whole_manifest"](spark, SF_SMALL).count() == docs.filter("doc_id % 4 = 0").count()
    want = {r["source"]: r["n"] for r in docs.groupBy("source").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    listed = {r["source"]: r["bytes"] for r in QUERIES["listed_files"](spark, SF_SMALL).collect()}
    assert set(listed) == set(want) and all(listed[s] > want[s] for s in want)
