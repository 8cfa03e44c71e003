"""Helpers that the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import scratch_path

#: Word separators of all word-based contracts, as a Java, RE2 and Python character class body.
BLANKS = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def col(name: str) -> Column:
    """Column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once for an expression that reads it many times, inside lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Array of the words of a text; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table below the shared folder and read it back: cut lineage, computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of rows with a table that holds each key once and, in `weight`, how many of the rows have it.

    Keys of more than an even share of the rows, at most as many as there are shares, are broadcast, so no task
    gets all rows of one key. Both sides are read twice: pass written tables.
    """
    shares = 4 * partitions(rows.sparkSession)
    total = table.agg(F.sum(weight).alias("n")).first()["n"] or 0
    heavy = F.col(weight) * shares > total
    hot = F.broadcast(table.where(heavy).drop(weight))
    cold = table.where(~heavy).drop(weight)
    rest = rows.join(hot.select(key), key, "left_anti").join(cold, key)
    return rows.join(hot, key).unionByName(rest)


def with_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies at the same path as on the driver.

    A cluster without such a path gets it by --py-files, as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
