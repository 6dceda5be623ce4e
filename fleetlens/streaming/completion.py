"""Completion counters as a Structured Streaming query.

Each completion callback is an event row; the master's counters become a
streaming aggregate per application in ``update`` mode. Each micro-batch's
changed rows are written by ``foreachBatch`` to
``<sink>/updates/batch_id=<n>`` (overwrite of that one folder, so a retried
batch is idempotent); the current counters are the row of the highest batch
per application.

State is never dropped: the reference keeps its counters for the life of an
application and has no expiry rule, and none is invented here. With an
unbounded stream of new applications the state store grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def completion_counts(stream: DataFrame, app_col: str, failed: Column) -> DataFrame:
    """Streaming (or batch) aggregate: callbacks seen and failures per app."""
    return stream.groupBy(F.col(app_col).alias("app_id")).agg(
        F.count(F.lit(1)).alias("done"),
        F.count_if(failed).alias("failed"))


def run_stream_completion(spark: SparkSession, source_dir: str, schema: T.StructType,
                          sink_dir: str, checkpoint_dir: str, app_col: str,
                          failed: Column, max_files_per_trigger: int = 1) -> DataFrame:
    """Run the stream over the files now in ``source_dir`` (``availableNow``),
    then return the current counters read back from the sink."""
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    counts = completion_counts(stream, app_col, failed)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir}/updates/batch_id={batch_id}")

    q = (counts.writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint_dir)
         .foreachBatch(write_batch)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return current_counts(spark, sink_dir)


def _latest(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("app_id")
            .agg(F.max_by(F.struct("done", "failed"), F.col("batch_id")).alias("_c"))
            .select("app_id", "_c.done", "_c.failed"))


def current_counts(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Latest counters per application, over all update batches."""
    return _latest(spark.read.parquet(f"{sink_dir}/updates"))
