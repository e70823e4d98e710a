"""Session construction and the shared work folder.

Settings that change results are pinned here (UTC session zone); settings that
only change the physical plan (AQE, skew handling) are turned on but may be
overridden by whoever owns the cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Result-affecting settings: event times are ISO-8601 UTC text, so the session
# zone must be UTC for parsed and stored timestamps to keep their wall clock.
PINNED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Plan-shaping defaults for sessions built here (tests, bench, scripts); the
# caller's ``conf`` overrides them. Sessions made elsewhere keep their own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Partition-overwrite writes replace only the batch partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Sizing: input splits and post-shuffle partitions of ~128 MB keep tasks
    # well inside executor memory; AQE coalesces small shuffle partitions, so
    # spark.sql.shuffle.partitions can be set high on a cluster (e.g. several
    # times the core count) without many tiny tasks at small scale.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Checkpointed tables are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "actiflow",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Pin result-affecting settings on an existing session (e.g. the driver's)."""
    for key, value in PINNED_CONF.items():
        spark.conf.set(key, value)
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() != "dynamic":
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured (local tests) is a private folder created;
    on a cluster a machine-local folder would not survive executor loss, so
    that case is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="actiflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def work_root(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "actiflow", purpose, uuid.uuid4().hex)
