"""Session helpers: sane defaults for local runs, shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "retentio", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench. Clusters build their own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RETENTIO_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in spark.checkpoint.dir (or the
    SparkContext's checkpoint dir when one was set programmatically)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the session's checkpoint folder; only when none is configured
    (local tests) create a fresh scratch folder."""
    d = checkpoint_dir(spark)
    if d is None:
        if not fallback and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = fallback or tempfile.mkdtemp(prefix="retentio-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(d)
    return d
