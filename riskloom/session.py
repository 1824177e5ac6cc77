"""Session helpers: a local session for tests/bench, and the checkpoint folder.

The library itself never creates a session; operators take DataFrames.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Settings for a large cluster (~100 TB input, ~1000 executors). Shuffle partitions are set
# high and AQE coalesces them to ~256 MB; skewed join partitions are split; the planner
# broadcasts only sides its statistics prove small; scans read ~256 MB splits.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of sorted or scored rows go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # spark.checkpoint.dir must point at the cluster's shared file system (set by the deployment)
}


def apply_cluster_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Set the runtime-modifiable SQL settings of ``CLUSTER_CONF`` on a session."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskloom") -> SparkSession:
    """A local-mode session configured like the cluster one (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster the folder must be set by the deployment (``spark.checkpoint.dir``,
    a shared file system). Only a local-mode session without one gets a fresh
    scratch folder, as in tests.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext: use its conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder for this cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder (HDFS/S3/ABFS) for this cluster"
        )
    folder = tempfile.mkdtemp(prefix="riskloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()
