"""Session helpers: the settings the pipeline relies on and the shared
checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators assume: UTC calendar dates (ANSI is the Spark 4
#: default), and joins may run on a partitioning by a subset of their keys,
#: so the ply join reuses the per-game partitioning of its window.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

#: Recommended settings for the pipeline jobs.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "plyspark",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **RECOMMENDED_CONF, **(extra or {})}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when a local session names none (tests) is a fresh local folder
    created and registered; a cluster's executors could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="plyspark-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: it is
    computed once, and lost executors recompute nothing before it."""
    path = scratch_path(df.sparkSession, f"plyspark_stored/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    """Integer setting from the session conf (e.g. ``spark.plyspark.*``)."""
    value = spark.conf.get(key, None)
    return default if value in (None, "") else int(value)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Inside, the session has these settings; afterwards it is as before."""
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Inside, shuffles are sized for an input of so many bytes
    (``partition_settings``) where the session's own setting is too small for
    it; afterwards the session is as before."""
    sized = partition_settings(input_bytes, spark.sparkContext.defaultParallelism)
    key = "spark.sql.shuffle.partitions"
    larger = int(sized[key]) > max(int(spark.conf.get(key)), 2 * spark.sparkContext.defaultParallelism)
    with settings(spark, sized if larger else {}):
        yield


def partition_settings(
    shuffle_input_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    expansion: float = 2.0,
    max_partitions: int = 100_000,
) -> dict[str, str]:
    """Shuffle and scan sizing for a stage that shuffles
    ``shuffle_input_bytes`` of (compressed) Parquet input.

    Shuffle partitions hold about ``target_partition_bytes`` of decompressed
    data (``expansion`` = decompressed/compressed ratio), never fewer than
    two waves of the cluster's cores. Above ``max_partitions`` the
    partitions grow instead, which keeps the map-output bookkeeping on the
    driver bounded. Scans split at the same target; AQE coalesces small
    partitions and splits skewed join partitions at runtime.
    """
    shuffle_bytes = int(shuffle_input_bytes * expansion)
    wanted = -(-shuffle_bytes // target_partition_bytes)
    partitions = min(max(2 * total_cores, wanted), max(max_partitions, 2 * total_cores))
    per_partition = max(target_partition_bytes, -(-shuffle_bytes // partitions))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_partition),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * per_partition),
    }
