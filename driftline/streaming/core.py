"""Stream plumbing: sources, sinks that survive a replayed batch, bounded runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WATERMARK = "10 minutes"


def parquet_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream over Parquet files of one table (`name` is a file name pattern in `folder`)."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def with_event_time(df: DataFrame, ts: str, delay: str | None = WATERMARK) -> DataFrame:
    """Event time as an instant (watermarks reject zone-less timestamps), with its watermark."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, delay) if delay else timed


def append_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Exactly-once append to a Parquet folder."""
    writer = df.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batch_sink(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """One folder per micro-batch: a replayed batch replaces its own output."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """Sink table, optionally only of batches before `below`; None before the first write."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise
    return (df if below is None else df.where(F.col("batch") < below)).drop("batch")


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded run; failures of the stream are raised."""
    query.awaitTermination()
