"""Append-only record tables: run records and contract alerts.

Records are keyed by run and never overwritten, so a later run cannot replace an earlier report.
Single writer per table is assumed.

What several tables must show together is written by event: each table gets a folder of the event, which a replay
replaces, and the last write is the event's row in a table of commits. Readers of `committed` see the rows of
committed events only, so a run that dies between two writes has changed nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_record(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame | None:
    """The record table, or None before its first append."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def write_event(df: DataFrame, path: str, event: int) -> DataFrame:
    """Rows of an event in a table, in place of those of an earlier attempt; read back."""
    folder = f"{path}/event={event}"
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def commit(spark: SparkSession, path: str, event: int, run: str, kind: str) -> None:
    """Make the rows of an event visible: one file, moved into place as a whole."""
    row = spark.range(1).select(F.lit(run).alias("run_id"), F.lit(kind).alias("kind"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/event={event}")


def is_committed(spark: SparkSession, path: str, event: int) -> bool:
    marks = read_records(spark, path)
    return marks is not None and not marks.where(F.col("event") == event).isEmpty()


def committed(spark: SparkSession, path: str, commits: str) -> DataFrame | None:
    """The rows of committed events, or None without any.

    Events are a handful and enter the plan as literals, so that folders of other attempts are not even listed as
    input: a replay may replace them while it reads the table.
    """
    rows, marks = read_records(spark, path), read_records(spark, commits)
    if rows is None or marks is None:
        return None
    events = [r["event"] for r in marks.select("event").distinct().collect()]
    return rows.where(F.col("event").isin(events)).drop("event")


def latest(df: DataFrame, by: Sequence[str], seq: str) -> DataFrame:
    """Latest row per key as one aggregation (no per-key sort)."""
    rest = [c for c in df.columns if c not in by]
    picked = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__r"))
    return picked.select(*by, "__r.*")


def alert_rows(
    summary: DataFrame, by: Sequence[str], *, message: str = "message", total: str = "total_failures"
) -> DataFrame:
    """Alert record per batch: `fail` with the report, or `pass` (which clears an older alert)."""
    failed = F.col(total) > 0
    return summary.select(
        *by,
        F.when(failed, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.when(failed, F.col(message)).alias("message"),
        F.col(total).alias("total_failures"),
    )


def open_alerts(alerts: DataFrame, source: Sequence[str], seq: str) -> DataFrame:
    """Sources whose latest validation failed."""
    return latest(alerts, source, seq).where(F.col("status") == "fail")
