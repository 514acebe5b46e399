"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


# Settings for a large cluster (about 100 TB of facts). Shuffles after partial
# aggregation are far smaller than the scans, so AQE starts from many shuffle
# partitions and coalesces them to the advisory size; skewed join partitions are split.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tillpoint") -> SparkSession:
    """A session in which the launcher's master and settings win.

    Only what neither the launcher nor the caller gives is filled in: ``local[*]`` with
    ``LOCAL_SETTINGS`` without any master, ``CLUSTER_SETTINGS`` on a cluster."""
    SparkContext._ensure_initialized()  # only then does SparkConf see what the launcher set
    given = SparkConf()
    builder = SparkSession.builder
    if not given.contains("spark.app.name"):
        builder = builder.appName(app)
    if master or not given.contains("spark.master"):
        builder = builder.master(master or "local[*]")
    at = master or given.get("spark.master", "local[*]")
    defaults = LOCAL_SETTINGS if at.startswith("local") else CLUSTER_SETTINGS
    for key, value in defaults.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, wiring it into the SparkContext.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is;
    without it a cluster job stops with an error. Only in local mode (tests) with
    nothing configured is a private folder created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's own spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage that every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="tillpoint-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written intermediates."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tillpoint", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run meanwhile go when it ends, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)
