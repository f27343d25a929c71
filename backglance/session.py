"""Session helpers: a local session for tests and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "backglance", memory: str = "8g") -> SparkSession:
    """A local session for tests and timing runs; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    A cluster names a shared folder in ``spark.checkpoint.dir``; only a local session
    without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="backglance-checkpoint-")
    context.setCheckpointDir(configured)
    return configured
