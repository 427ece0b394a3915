"""Session helpers.

`local_session` is for tests and the bench only; library code never builds a
session. `work_root` finds the shared folder the cluster names in
``spark.checkpoint.dir``; only a local master without one gets a folder of its
own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts from
# runtime sizes, splits skewed join partitions, and coalesces small ones.
SCALE_CONFIGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.mergeSchema": "false",
}


# Starting points for a large cluster reading ~100 TB (not applied by the
# library; set them on the cluster's session). Inputs split into ~256 MB
# tasks; shuffles start wide and AQE coalesces them to ~256 MB partitions, so
# no task spills badly; skewed join partitions above 1 GB (5x the median) are
# split; broadcasts stay under Spark's checked 64 MB limit.
CLUSTER_HINTS = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SCALE_CONFIGS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for staged writes, state and stream checkpoints.

    Taken from ``spark.checkpoint.dir`` (or a checkpoint dir already set on
    the context). A local master with neither gets a temporary folder; on a
    cluster the setting is required, as a machine-local folder would not be
    seen by the executors.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for tidemark")
    path = tempfile.mkdtemp(prefix="tidemark-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the work root (never reused)."""
    return f"{work_root(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"
