"""Running a stateful stream over the files that are there, with an update log.

Each micro-batch's rows go to ``<sink>/updates/batch_id=<n>``, one folder per
batch that a retry overwrites, so that a batch run twice counts once. Readers
take the last row of each key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Else every write looks first whether the key is there, to count keys for the
#: progress report.
COUNT_KEYS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in
    RocksDB, as arbitrary state with several variables and timers needs; the
    caller's own settings stay as they are."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set(PROVIDER, ROCKSDB)
    session.conf.set(COUNT_KEYS, "false")
    return session


def file_stream(session: SparkSession, source_dir: str, schema: T.StructType, max_files_per_trigger: int) -> DataFrame:
    """The parquet files of a folder as a stream, oldest first."""
    return (session.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(source_dir))


def run_updates(rows: DataFrame, sink_dir: str, checkpoint_dir: str, mode: str) -> None:
    """Run a streaming DataFrame over what its source has now, to the end."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir}/updates/batch_id={batch_id}")

    query = (rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint_dir)
             .foreachBatch(write_batch).trigger(availableNow=True).start())
    query.awaitTermination()


def run_stateful(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint_dir: str,
                 build: Callable[[DataFrame], DataFrame], max_files_per_trigger: int = 1) -> DataFrame:
    """``build`` over the stream of ``source_dir`` in append mode, with state
    in RocksDB, over the files that are there and not yet read; the update log so
    far, with each row's ``batch_id``."""
    rows = build(file_stream(stateful_session(spark), source_dir, schema, max_files_per_trigger))
    run_updates(rows, sink_dir, checkpoint_dir, "append")
    return spark.read.schema(rows.schema.add("batch_id", T.LongType())).parquet(f"{sink_dir}/updates")


def last_of_key(log: DataFrame, key: str) -> DataFrame:
    """The last row of each key in an update log."""
    values = [c for c in log.columns if c not in (key, "batch_id")]
    return (log.groupBy(key).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("_last"))
            .select(key, "_last.*"))
