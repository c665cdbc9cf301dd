"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

def build_session(app_name: str = "recordflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is written for.

    Nothing here depends on the data size: partition counts are left to AQE
    (coalescing from ``spark.sql.shuffle.partitions``), broadcast decisions to
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A cluster without the setting is an error. A local master, where driver and
    executors share one disk, gets a folder set for the session if it has none.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="recordflow-"))
    return spark.sparkContext.getCheckpointDir()


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [x for x in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch path below the shared folder, once its owner's result has been written."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = found.getFileSystem(spark._jsc.hadoopConfiguration())
    root = store.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark)))
    above = store.makeQualified(found).getParent()
    while above is not None and not above.equals(root):
        above = above.getParent()
    if above is None or ".." in path.split("/"):
        raise ValueError(f"{path} is not below the shared folder")
    store.delete(found, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")

