"""Derived views over the driver tables (FIXTURES.md section 3).

The same text runs in Spark SQL and DuckDB, so the Spark queries and the
oracle see identical inputs. In Spark, each base table is handed to
``spark.sql`` as a DataFrame argument (no global temp-view names), and the
parquet scans stay lazy: Catalyst prunes columns and pushes filters through
the view into the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

# Fixed view definitions, shared with the oracle.
VIEW_SQL: dict[str, str] = {
    "apps": """
SELECT o_orderkey AS app_id, o_custkey AS user_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'etl' WHEN '2-HIGH' THEN 'report'
    WHEN '3-MEDIUM' THEN 'train' ELSE 'adhoc' END AS name,
  CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'ACCEPTED' END AS state,
  o_orderdate AS started
FROM orders""",
    "containers": """
SELECT concat('container_1700000000000_', lpad(CAST(l_orderkey AS STRING), CAST(greatest(9, length(CAST(l_orderkey AS STRING))) AS INT), '0'),
    CASE WHEN l_suppkey % 3 = 0 THEN '_02_' ELSE '_01_' END,
    lpad(CAST(l_linenumber AS STRING), CAST(greatest(6, length(CAST(l_linenumber AS STRING))) AS INT), '0')) AS container_id,
  min(l_suppkey) AS node_id,
  max(CAST(l_quantity AS INT)) * 64 AS memory_mb,
  max(CASE WHEN l_shipdate < TIMESTAMP '2000-01-01 00:00:00' THEN 1 ELSE 0 END) AS completed,
  max(CASE WHEN l_shipdate < TIMESTAMP '2000-01-01 00:00:00' AND l_returnflag = 'R'
    AND l_linestatus = 'F' THEN 1 ELSE 0 END) AS exit_status
FROM lineitem GROUP BY 1""",
    "nodes": """
SELECT s_suppkey AS node_id, s_nationkey AS cluster_id,
  CAST(floor(abs(s_acctbal)) AS INT) AS avail_mb, CAST(s_suppkey % 16 + 1 AS INT) AS avail_vcores
FROM supplier""",
    "requests": """
SELECT p_partkey AS request_id, CAST(p_partkey % 25 AS INT) AS cluster_id,
  CAST(p_partkey % 3 + 1 AS INT) AS num_containers, p_size * 250 AS memory_mb,
  CAST(p_partkey % 20 + 1 AS INT) AS vcores
FROM part""",
    "state_events": """
SELECT event_id, user_id AS app_id, ts,
  CASE event_type WHEN 'signup' THEN 'SUBMITTED' WHEN 'click' THEN 'ACCEPTED'
    WHEN 'view' THEN 'RUNNING' WHEN 'purchase' THEN 'FINISHED' ELSE 'FAILED' END AS state
FROM events""",
    "packages": """
SELECT p_brand AS env_name, p_name AS spec, p_partkey AS pos FROM part""",
    "local_files": """
SELECT concat(source, '/', CAST(doc_id AS STRING),
    CASE WHEN doc_id % 4 = 0 THEN '.zip' ELSE '.txt' END) AS path,
  source AS app, n_chars AS size, CAST(1700000000 + doc_id * 60 AS BIGINT) AS mtime
FROM documents""",
    "remote_files": """
SELECT concat(source, '/', CAST(doc_id AS STRING),
    CASE WHEN doc_id % 4 = 0 THEN '.zip' ELSE '.txt' END) AS path,
  CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS size,
  CAST(1700000000 + doc_id * 60 + CASE WHEN doc_id % 7 = 0 THEN 0 ELSE 1 END AS BIGINT) AS last_mod
FROM documents WHERE doc_id % 3 <> 0""",
    "uris": """
SELECT doc_id AS ref_id,
  CASE doc_id % 3 WHEN 0 THEN concat('hdfs://', source, '/f', CAST(doc_id % 50 AS STRING))
    WHEN 1 THEN concat('hdfs:///', source, '/f', CAST(doc_id % 50 AS STRING))
    ELSE concat('/data/', source, '/f', CAST(doc_id % 50 AS STRING)) END AS uri
FROM documents""",
    "config_layers": """
SELECT CAST(user_id % 4 AS INT) AS priority,
  CASE user_id % 4 WHEN 0 THEN 'yarn' WHEN 1 THEN 'core' WHEN 2 THEN 'pars' ELSE 'kwargs' END AS layer,
  concat(event_type, CAST(event_id % 20 AS STRING)) AS key, event_id AS seq,
  CAST(value AS STRING) AS value
FROM events""",
    # Captured ids as they come: one in 50 has lost its last part, one in 77 its
    # prefix, and some are null.
    "captured_containers": """
SELECT CASE WHEN l_orderkey % 50 = 1 THEN concat('container_1700000000000_', CAST(l_orderkey AS STRING), '_01')
    WHEN l_orderkey % 77 = 2 THEN concat('1700000000000_', CAST(l_orderkey AS STRING), '_01_', CAST(l_linenumber AS STRING))
    WHEN l_orderkey % 91 = 3 THEN NULL
    ELSE concat('container_', CASE WHEN l_suppkey % 4 = 0 THEN 'e17_' ELSE '' END,
      CASE WHEN l_orderkey % 2 = 0 THEN '1700000000000_' ELSE '1700000099999_' END, CAST(l_orderkey AS STRING),
      '_01_', CAST(l_linenumber AS STRING)) END AS container_id,
  CASE WHEN l_shipdate < TIMESTAMP '2000-01-01 00:00:00' THEN 1 ELSE 0 END AS completed,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS exit_status
FROM lineitem""",
    # Properties of two site files a cluster, with repeats within a file (seq) and across.
    "site_properties": """
SELECT s_suppkey AS cluster_key, 'yarn-site' AS layer, 0 AS seq, 'yarn.resourcemanager.hostname' AS key,
  concat('host', CAST(s_suppkey AS STRING)) AS value FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL
SELECT s_suppkey, 'yarn-site', 1, 'dfs.replication', '9' FROM supplier
UNION ALL
SELECT s_suppkey, 'yarn-site', 2, 'dfs.replication', CAST(s_suppkey % 4 + 10 AS STRING) FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL
SELECT s_suppkey, 'yarn-site', 3, 'yarn.resourcemanager.webapp.address',
  concat('web', CAST(s_suppkey AS STRING), '.example.com:', CAST(9000 + s_suppkey AS STRING))
FROM supplier WHERE s_suppkey % 3 = 1
UNION ALL
SELECT s_suppkey, 'core-site', 0, 'dfs.replication', '2' FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL
SELECT s_suppkey, 'core-site', 1, 'yarn.resourcemanager.webapp.address', concat('Core', CAST(s_suppkey AS STRING))
FROM supplier WHERE s_suppkey % 6 = 1
UNION ALL
SELECT s_suppkey, 'core-site', 2, 'yarn.resourcemanager.webapp.https.address',
  concat('web', CAST(s_suppkey AS STRING), ':', CAST(9500 + s_suppkey AS STRING))
FROM supplier WHERE s_suppkey % 5 = 1""",
    # A node of a queue tree: 256 of them to a response, each under one before it.
    "queue_nodes": """
SELECT CAST(floor(c_custkey / 256) AS BIGINT) AS response, CAST(c_custkey % 256 AS INT) AS node,
  CAST(c_custkey % 100 AS DOUBLE) / 4 AS capacity, CASE WHEN c_nationkey % 5 = 0 THEN 'STOPPED' ELSE 'RUNNING' END AS state,
  c_nationkey AS n_apps
FROM customer""",
    "channels": """
SELECT p_brand AS env_name, concat('channel-', CAST(p_size % 7 AS STRING)) AS spec FROM part WHERE p_size % 3 = 0""",
    "raw_config": """
SELECT s_suppkey AS cluster_key, 'yarn.resourcemanager.hostname' AS key,
  concat('host', CAST(s_suppkey AS STRING)) AS value FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL
SELECT s_suppkey, 'yarn.resourcemanager.webapp.address',
  concat('web', CAST(s_suppkey AS STRING), '.example.com:', CAST(9000 + s_suppkey AS STRING))
FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL
SELECT s_suppkey, 'yarn.resourcemanager.webapp.https.address',
  concat('web', CAST(s_suppkey AS STRING), ':', CAST(9500 + s_suppkey AS STRING))
FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL
SELECT s_suppkey, 'dfs.replication', CAST(s_suppkey % 4 + 1 AS STRING) FROM supplier WHERE s_suppkey % 7 = 0""",
}

_FROM = re.compile(r"\bFROM (\w+)")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Views:
    """Lazy access to base tables and derived views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def view(self, name: str) -> DataFrame:
        key = "view:" + name
        if key not in self._cache:
            sql = VIEW_SQL[name]
            names = sorted(set(_FROM.findall(sql)))
            text = _FROM.sub(lambda m: "FROM {" + m.group(1) + "}", sql)
            self._cache[key] = self.spark.sql(
                text, **{n: self.table(n) for n in names})
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEW_SQL:
            return self.view(name)
        if name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)


def with_views(select_sql: str, *views: str) -> str:
    """Oracle text: the named views as CTEs in front of a final SELECT."""
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in views)
    return f"WITH {ctes}\n{select_sql.strip()}" if views else select_sql.strip()
