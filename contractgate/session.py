"""Session helpers: a local session for tests and benchmarks, and the shared
work folder taken from the session's ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "contractgate") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CONTRACTGATE_DRIVER_MEMORY", "8g"))
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    # tiny local inputs: let AQE keep enough write tasks for the cores
    builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset: it gets a fresh folder under
    the system temp directory. On a cluster that is an error, as executors would
    each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="contractgate-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str, fresh: bool = False) -> str:
    """A folder for a job's zones under the shared checkpoint root.

    ``fresh`` adds a unique suffix so that repeated runs never share state.
    """
    suffix = f"-{uuid.uuid4().hex[:12]}" if fresh else ""
    return f"{checkpoint_root(spark)}/contractgate/{name}{suffix}"
