"""Exact dedup, fingerprints and profiling of a batch table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_VALUES = 60  # Fixed value: distinct values listed per categorical column.


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (null equals null). Copies collapse before the shuffle."""
    return df.dropDuplicates()


def dedup_count(df: DataFrame) -> DataFrame:
    """rows_in, rows_out and rows_dropped in one pass."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows_in"),
        F.count("*").alias("rows_out"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("rows_dropped"),
    )


def row_hash(df: DataFrame, columns: Sequence[str], algorithm: str = "xxhash64") -> Column:
    """64-bit row hash; the md5 form uses text any SQL engine can rebuild."""
    if algorithm == "xxhash64":
        return F.xxhash64(*[F.col(c) for c in columns])
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), algorithm: str = "xxhash64"
) -> DataFrame:
    """Order-insensitive content fingerprint.

    xor alone cancels pairs of equal rows, so a sum of the low hash bits stands beside it (20 bits:
    no overflow below 8e12 rows).
    """
    columns = list(columns or df.columns)
    hashed = df.select(*by, row_hash(df, columns, algorithm).alias("__h"))
    return hashed.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.bit_xor("__h").alias("hash_xor"),
        F.sum(F.pmod(F.col("__h"), F.lit(1 << 20))).alias("hash_sum"),
    )


def refresh_manifest(
    listing: DataFrame,
    known: DataFrame | None,
    read: Callable[[list[str]], DataFrame],
    columns: Sequence[str] | None = None,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """One row per listed file: file, path, n_bytes, changed_at and the file's n_rows, hash_xor, hash_sum.

    Entries of `known`, an earlier manifest over the same columns, are taken over where name, size and time are
    unchanged; only other files are read, by `read(paths)`. Files that are gone drop out, a file without rows keeps
    an entry of zeros. The driver sees the names of files to read, as it does in any scan.
    """
    same = ["file", "n_bytes", "changed_at"]
    fresh = listing.join(known.select(same), same, "left_anti") if known is not None else listing
    paths = [r["path"] for r in fresh.select("path").collect()]
    if not paths:
        return listing.join(known.drop("path"), same) if known is not None else _entries(listing, None)
    rows = read(paths)
    hashed = fingerprint(rows.withColumn("file", F.col("_metadata.file_path")), columns or rows.columns, ["file"], algorithm)
    entries = _entries(fresh, hashed)
    return listing.join(known.drop("path"), same).select(entries.columns).unionByName(entries) if known is not None else entries


def _entries(listing: DataFrame, hashed: DataFrame | None) -> DataFrame:
    names = ("n_rows", "hash_xor", "hash_sum")
    zero = F.lit(0).cast("bigint")
    if hashed is None:
        return listing.select("file", "n_bytes", "changed_at", "path", *(zero.alias(n) for n in names))
    return listing.join(hashed, "file", "left").select(
        "file", "n_bytes", "changed_at", "path", *(F.coalesce(F.col(n), zero).alias(n) for n in names)
    )


def combine_manifest(manifest: DataFrame, by: Sequence[Column] = ()) -> DataFrame:
    """The fingerprint of all rows of the listed files, from their entries alone."""
    return manifest.groupBy(*by).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.bit_xor("hash_xor").alias("hash_xor"),
        F.sum("hash_sum").alias("hash_sum"),
    )


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def profile_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: missing_ratio, min, max, mean, sample std (null when all values are missing).

    NaN counts as missing.
    """
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        if df.schema[c].dataType.typeName() in ("double", "float"):
            v = F.when(~F.isnan(v), v)
        aggs += [
            F.avg(v.isNull().cast("double")).alias(f"m{i}"),
            F.min(v).cast("double").alias(f"lo{i}"),
            F.max(v).cast("double").alias(f"hi{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"sd{i}"),
        ]
    entries = ", ".join(
        f"struct('{c}' AS column, m{i} AS missing_ratio, lo{i} AS min, hi{i} AS max, mean{i} AS mean, sd{i} AS std)"
        for i, c in enumerate(cols)
    )
    return df.agg(*aggs).select(F.expr(f"inline(array({entries}))"))


def unpivot_text(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., column, value) of text columns."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    )
    return df.select(*keep, F.explode(entries).alias("__e")).select(*keep, "__e.*")


def profile_top_values(df: DataFrame, cols: Sequence[str], k: int = TOP_VALUES) -> DataFrame:
    """Most frequent values per column, null counted as `Missing`; ties ordered by value.

    The row_number filter lets each task keep only its own top k before the final shuffle.
    """
    long = unpivot_text(df, cols).select("column", F.coalesce("value", F.lit("Missing")).alias("value"))
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
