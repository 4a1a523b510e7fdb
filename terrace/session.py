"""Session helpers: a local session for tests/bench and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "terrace") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller supplies its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TERRACE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only when the session names none (local tests) is a private folder created and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # no local SparkContext (e.g. Spark Connect)
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="terrace-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the scratch root (one per call, never reused)."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_dirs(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate folders that nothing reads any more (what was made of them is written)."""
    from terrace.sources import files

    for path in paths:
        files.remove(spark, path)
