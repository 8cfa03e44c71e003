"""Session helpers: local session for tests and the shared folder for durable scratch data."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str = "driftline", cores: str = "8", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    A bare local session that names none gets a temporary folder; on a cluster that is an error,
    because executors would not see each other's files.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="driftline-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure `checkpoint()` and iterative ML have a folder to cut lineage in."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh folder below the shared root for a written intermediate table or stream sink."""
    return os.path.join(shared_root(spark), "driftline", f"{name}-{uuid.uuid4().hex}")
