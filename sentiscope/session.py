"""Session construction and the shared checkpoint folder.

On a cluster the session is built by the caller; the library only reads
``spark.checkpoint.dir`` from it.  A folder of our own is set only when that
setting is missing *and* the master is local (tests, the bench, smoke runs).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "sentiscope", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    The operators need the session zone to be UTC (timestamps are compared with
    the DuckDB oracle) and AQE on (runtime broadcast / skew handling).
    """
    master = master or os.environ.get("SENTISCOPE_MASTER")
    builder = SparkSession.builder.appName(app_name)
    if master:  # otherwise spark-submit or Spark's own default decides
        builder = builder.master(master)
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SENTISCOPE_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``.  Only when it is unset and Spark runs in
    local mode is a scratch folder created (tests); on a cluster an unset value
    is an error, because a machine-local folder would not survive executor loss.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    path = tempfile.mkdtemp(prefix="sentiscope-ckpt-", dir=os.environ.get("SENTISCOPE_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame under the shared checkpoint folder and read it back: a cut lineage of known size."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, number: int):
    """The number of shuffle partitions of what starts inside, for instance of a stream over a small closed key set.

    A stream takes the session's settings when it starts; one with state keeps its first number in the checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(number))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def side_by_side(spark: SparkSession, *todo: Callable) -> list:
    """The results of independent steps that run at the same time; their jobs belong to the caller's (a stopped query ends them)."""
    with ThreadPoolExecutor(len(todo)) as pool:
        return [found.result() for found in [pool.submit(inheritable_thread_target(spark)(step)) for step in todo]]


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    Shuffle partitions are sized so one post-shuffle partition is about
    ``target_partition_bytes`` (never fewer than 2 per core); AQE then coalesces
    small ones and splits skewed ones (a key holding a large share of the rows is
    split into several tasks instead of one).  Scan splits are capped at the same
    size so a task's input fits executor memory without spilling.
    """
    partitions = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


def spread(scan: DataFrame, per_core: int = 2) -> DataFrame:
    """Give CPU-heavy row work (tokenising long texts) at least ``per_core`` tasks per core.

    Takes a bare file scan, whose split count is known without running a job.  A small
    table can be read in fewer splits than the cluster has cores; it is dealt out
    round-robin.  A large one has more splits than that and is returned as it is, so no
    text is shuffled for it.  The rows are the same either way.
    """
    target = per_core * scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < target:
        return scan.repartition(target)
    return scan
