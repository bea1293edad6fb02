"""Session helpers.

Library code never creates a session; it takes the caller's. ``local_session`` is
for tests and ``bench.py`` only. ``checkpoint_dir`` reads the cluster's shared
``spark.checkpoint.dir`` and only gives a session on a local master a scratch folder when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run of the library expects; cluster launchers set the same keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A runtime-checked broadcast: AQE only turns a shuffle join into a broadcast
    # once the materialised side is known to be below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "grainline") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", scratch_dir()))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def scratch_dir() -> str:
    """A new local folder, for sessions on a local master only."""
    return tempfile.mkdtemp(prefix="grainline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names (``spark.checkpoint.dir``, or the SparkContext's checkpoint directory).
    A session on a local master that names none gets a scratch folder, as its context's checkpoint directory."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not current:
        current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to executors on other hosts
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        current = scratch_dir()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current
