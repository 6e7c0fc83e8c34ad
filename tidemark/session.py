"""Session helpers: a tuned local session for tests and benchmarks, and the
shared scratch folder every job must use for staged data.

On a cluster the scratch root is the folder named by ``spark.checkpoint.dir``
(shared storage every executor can reach). It is read from the session; only
callers that own the session (tests, bench, the driver hook) may set one when
it is unset, and then under the SQL warehouse, which is shared as well.
Library code never falls back to a machine-local folder.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession


# Settings the jobs assume on a large cluster (apply with builder.config or
# spark-submit --conf). AQE sizes shuffle partitions from runtime statistics
# and splits skewed join partitions; the advisory size keeps each task's
# shuffle input well inside executor memory; the initial partition number
# is high enough for 100 TB inputs and is coalesced down by AQE when smaller.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only what AQE has measured (shuffle output of a finished
    # stage), never on a planning-time estimate
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.sources.partitionOverwriteMode": "static",   # jobs ask for dynamic per write
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def ensure_checkpoint_root(spark: SparkSession) -> str:
    """Return the shared scratch root and make sure ``DataFrame.checkpoint``
    uses it. A session that names none gets a folder under its SQL warehouse,
    which driver and executors share; a machine-local folder is never used."""
    root = checkpoint_root(spark)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def stage_folder(spark: SparkSession, name: str, target: str) -> str:
    """The staging folder of one target under the shared scratch root. It is
    the same folder on every run of that target (the next run overwrites it),
    so staged copies never pile up, and it survives a failed publish so the
    run can be completed from it."""
    root = checkpoint_root(spark)
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: staged data needs a shared folder")
    digest = hashlib.sha1(target.encode()).hexdigest()[:12]
    return f"{root.rstrip('/')}/tidemark-stage/{name}-{digest}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root (never reused,
    never cleared: each call names a new one)."""
    root = checkpoint_root(spark)
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: staged data needs a shared folder")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
