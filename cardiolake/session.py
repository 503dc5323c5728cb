"""Session helpers: sane defaults and a shared checkpoint directory."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cardiolake") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("CARDIOLAKE_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``.

    On a cluster this is a shared folder set by the deployment and is only
    read here; without it an error is raised, as executors do not see a folder of
    the driver's machine. A local session without it gets a scratch folder.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not cur:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="cardiolake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return sc.getCheckpointDir() or cur
