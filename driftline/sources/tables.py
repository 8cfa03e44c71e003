"""Batch sources and stage sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions import columns as X
from driftline.spec import TableSpec


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with header, every column text, the CSV null tokens turned into null.

    Nothing is inferred (inference would scan the file twice and depend on the sample). Pass
    `columns` to skip the header probe.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    raw = reader.csv(path)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*X.CSV_NULLS), F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_table(spark: SparkSession, path: str, spec: TableSpec, fmt: str = "csv") -> DataFrame:
    """Read a raw table, drop its leak columns and coerce it to the contract types."""
    raw = read_csv_text(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return coerce(raw, spec)


def drop_leaks(df: DataFrame, leaks: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Remove leak columns that are present; also returns which ones were."""
    present = [c for c in leaks if c in df.columns]
    return df.drop(*present), present


def coerce(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Contract types for declared columns; other columns pass through untouched."""
    df, _ = drop_leaks(df, spec.leak)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c == spec.date:
            out.append(X.to_date(col, is_text=c in text).alias(c))
        elif c in spec.numeric:
            out.append(X.to_double(col, is_text=c in text).alias(c))
        elif c in spec.categorical or c == spec.target:
            out.append(X.norm_text(col).alias(c))
        else:
            out.append(col)
    return df.select(*out)


def align(df: DataFrame, columns: dict[str, T.DataType | str]) -> DataFrame:
    """Exactly the given columns; absent ones become typed nulls."""
    return df.select(
        *[
            F.col(f"`{c}`").alias(c) if c in df.columns else F.lit(None).cast(t).alias(c)
            for c, t in columns.items()
        ]
    )


def parse_requests(df: DataFrame, json_col: str, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """JSON request -> one row with every contract column, null where the key is absent.

    Works on batch and streaming input. Malformed JSON gives an all-null row, which the contract
    then rejects through its not-null rules.
    """
    parsed = df.select(*keep, F.from_json(F.col(json_col), spec.request_schema()).alias("__r"))
    return coerce(parsed.select(*keep, "__r.*"), spec)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write one stage table of a run; rewriting a stage replaces it."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_stage(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read a stage table; a split filter prunes to that split's directory."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """Data files below a path: file (as `_metadata.file_path` names it), path to read, n_bytes, changed_at."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("file"),
        "path",
        F.col("length").alias("n_bytes"),
        F.col("modificationTime").alias("changed_at"),
    )


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes below a path; only the listing is read (`content` is pruned)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("n_bytes")
    )
