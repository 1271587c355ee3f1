"""Session helpers: local sessions for tests/bench and shared scratch locations.

Scratch output (landed snapshots, quarantine, table versions written by the
registered checks) goes under the folder the cluster names in
``spark.checkpoint.dir`` — a shared, fault-tolerant location — never under a
machine-local temporary folder. A local folder is only set when the session has
none configured (tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "contrail", event_log_dir: str | None = None
) -> SparkSession:
    """Session for tests and local benchmarks (UI off, AQE on). With
    ``event_log_dir`` Spark writes its event log there (job/stage/task times)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. Where none is set, a local session gets a
    temporary one; on a cluster that would be a different folder on each machine, so it raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        conf = tempfile.mkdtemp(prefix="contrail-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for one run."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    base = conf or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/contrail/{name}-{uuid.uuid4().hex[:12]}"
