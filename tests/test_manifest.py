"""Mergeable data version: entries of unchanged files are taken over, only others are read."""

import os

import pytest
from pyspark.sql import functions as F

from driftline.operators import ingest
from driftline.sources import tables


@pytest.fixture()
def store(spark, tmp_path):
    folder, reads = str(tmp_path / "some data"), []
    schema = "k long, name string"

    def add(low, high):
        rows = spark.range(low, high).select(F.col("id").alias("k"), F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("name"))
        rows.coalesce(1).write.mode("append").parquet(folder)

    def read(paths):
        reads.append(len(paths))
        return spark.read.schema(schema).parquet(*paths)

    def refresh(known, step):
        kept = str(tmp_path / f"manifest-{step}")
        ingest.refresh_manifest(tables.file_listing(spark, folder), known, read).write.parquet(kept)
        return spark.read.parquet(kept)

    def whole():
        return ingest.fingerprint(spark.read.schema(schema).parquet(folder)).collect()

    return folder, reads, add, refresh, whole


def test_adding_one_file_reads_one_file(spark, store):
    folder, reads, add, refresh, whole = store
    add(0, 100), add(100, 150), add(150, 151)
    first = refresh(None, 1)
    assert reads == [3] and first.count() == 3
    assert ingest.combine_manifest(first).collect() == whole()
    add(0, 40)  # repeats of earlier rows
    second = refresh(first, 2)
    assert reads == [3, 1] and second.count() == 4
    assert ingest.combine_manifest(second).collect() == whole()
    third = refresh(second, 3)
    assert reads == [3, 1]
    assert sorted(third.select("file", "hash_xor").collect()) == sorted(second.select("file", "hash_xor").collect())


def test_changed_gone_and_empty_files(spark, store):
    folder, reads, add, refresh, whole = store
    add(0, 30), add(30, 60), add(60, 90)
    first = refresh(None, 1)
    a, b, _ = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(os.path.join(folder, a), "rb") as other:
        content = other.read()
    # one file gets another's rows, so its time changes; its checksum goes with it
    with open(os.path.join(folder, b), "wb") as changed:
        changed.write(content)
    os.utime(os.path.join(folder, b), (1_900_000_000, 1_900_000_000))
    os.remove(os.path.join(folder, f".{b}.crc"))
    second = refresh(first, 2)
    assert reads == [3, 1] and ingest.combine_manifest(second).collect() == whole()
    os.remove(os.path.join(folder, a))
    third = refresh(second, 3)
    assert reads == [3, 1] and third.count() == 2 and ingest.combine_manifest(third).collect() == whole()
    add(0, 0)
    fourth = refresh(third, 4)
    assert ingest.combine_manifest(fourth).collect() == whole()
    n = len(reads)
    assert refresh(fourth, 5).count() == fourth.count() and len(reads) == n
