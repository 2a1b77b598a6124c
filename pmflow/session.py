"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job relies on: UTC for all date logic, AQE with skew-join
# splitting for hot wallets / hot blocks, dynamic partition overwrite for
# idempotent per-file rewrites.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a command's shuffle files go when it ends, not when the driver happens to collect its garbage
    CLEANUP: "true",
    "spark.ui.enabled": "false",
    # streaming state (running daily totals) in RocksDB, off-heap and checkpointed incrementally
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "pmflow", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession, *, cleanup: bool = True) -> None:
    """Set the runtime-settable defaults on an existing session. ``cleanup``: whether
    a command's shuffle files go with it; who runs one plan twice would make them again."""
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, DEFAULT_CONF[k])
    spark.conf.set(CLEANUP, str(cleanup).lower())


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem). Only when it is unset (local tests) do we create one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = tempfile.mkdtemp(prefix="pmflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    import uuid
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(p: str) -> str:
    return p if "://" in p else os.path.abspath(p)
