"""Session helpers: the settings every job here relies on, and the shared
folder used to cut lineage or materialise a layer."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the panel jobs rely on.  AQE re-plans joins from runtime sizes
# (so a small side becomes a broadcast only after its size is measured) and
# splits skewed shuffle partitions.
SESSION_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remove checkpoint files of RDDs that are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings that may be changed on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, under ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local temporary
    folder would be invisible to other executors).  Only a local session
    without it gets a fresh temporary folder, as in tests.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required "
                "to materialise tables or checkpoint on a cluster")
        base = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()  # the form that later calls give
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    base = str(base)
    return os.path.join(base, *parts) if parts else base


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did,
    if that folder is not on their path already."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
