"""Spark session settings and the shared scratch folder.

Scratch data (derived log files, streaming checkpoints, lineage cuts) goes to
the folder the cluster names in ``spark.checkpoint.dir``. Only a local-mode
session without that setting (tests, benches) gets a private temp folder; a
cluster session without it is an error, since a machine-local folder is not
visible to other executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole documents travel to Python workers in Arrow batches; with texts
    # of up to ~150 KB, 2,000 rows keep a batch in the low hundreds of MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "fleetlens", extra: dict | None = None) -> SparkSession:
    """Session for tests and benches; a cluster job passes its own builder."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Order: ``spark.checkpoint.dir`` from the session conf, then a folder
    already given to ``setCheckpointDir``; a local session without either
    gets a fresh temp folder (also set as the RDD checkpoint folder).
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    existing = sc.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared "
            "folder for scratch data and lineage cuts")
    root = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder and
    return a DataFrame that reads it back. For results used several times
    in one plan; survives the loss of the executors that computed it
    (unlike ``localCheckpoint``, which is never used here)."""
    checkpoint_root(spark)
    return df.checkpoint(eager=True)


def cluster_conf(total_cores: int, state_store_rocksdb: bool = True) -> dict[str, str]:
    """Settings for a large cluster, to pass to the session builder.

    Shuffle partitions at three per core, then AQE coalesces small ones to
    the advisory size and splits skewed join partitions; scan splits of
    256 MB. Streaming state in RocksDB keeps many applications' counters off
    the JVM heap. ``spark.checkpoint.dir`` must name a shared folder.
    """
    conf = dict(DEFAULT_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    })
    if state_store_rocksdb:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return conf
