"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on (see README "Session").
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition directories such as co_uf=01 must come back as text, not int 1.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Only the changed partitions of a published table are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "vigiframe", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set the per-session SQL settings the library needs on an existing session."""
    for key in ("spark.sql.sources.partitionColumnTypeInference.enabled",
                "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(key, BASE_CONF[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in spark.checkpoint.dir.

    On a cluster that setting points at shared storage and is respected as is.
    Only when it is unset (local tests) a scratch folder is created for it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - some deployments hide core confs
            configured = None
    if not configured:
        configured = tempfile.mkdtemp(prefix="vigiframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings that keep partitions near ``target_partition_bytes`` at a given input size.

    * Scans: ``maxPartitionBytes`` = target, so a task reads ~one target of Parquet.
    * Shuffles: start with enough partitions for the whole input at the target size
      (at least 2 waves of the cluster's cores, at most 100k), and let AQE coalesce
      small ones to the same advisory size; AQE also splits skewed partitions of
      plain shuffle joins and turns joins into broadcasts only when a side is
      measured small at run time. (Hot keys in the library's own aggregate-then-join
      plans are salted explicitly; AQE's split does not reach those.)

    For 100 TB on 1000 executors x 8 cores: ~100k initial shuffle partitions of
    ~1 GB uncompressed data, coalesced by AQE after partial aggregation.
    """
    parts = max(2 * total_cores, min(100_000, input_bytes // target_partition_bytes + 1))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    }
