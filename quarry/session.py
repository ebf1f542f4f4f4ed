"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for the library: AQE on, UI off, UTC clock.

    On a cluster the master, memory and checkpoint dir come from spark-submit;
    here we only fill in what is unset.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session, or taken from a checkpoint folder already set. Only
    a local run may go without: it gets a private folder. On a cluster that
    folder would be seen by one machine only, so there its absence is an error.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _ROOTS:
        return _ROOTS[app]
    root = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quarry-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    _ROOTS[app] = root.rstrip("/")
    return _ROOTS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path
