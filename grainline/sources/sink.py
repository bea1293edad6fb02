"""Partitioned sink for pipeline outputs.

Written Hive-style by (business_year, state_code); readers filtering on those columns prune whole
directories. ``replace`` drops what was there and writes anew (drop and recreate); ``partitions`` replaces
only the folders of the years and states in the new rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, mode: str = "replace",
                      partition_by: Sequence[str] = ("business_year", "state_code")) -> None:
    if mode not in ("replace", "partitions"):
        raise ValueError("mode is 'replace' (drop and recreate) or 'partitions' (only the new rows' folders)")
    # Cluster rows by the partition columns (each task writes few files) with a REBALANCE, not a plain
    # hash repartition: AQE splits a partition that grows past the advisory size, so a state holding a
    # third of all rows is written by many tasks instead of one.
    (df.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "static" if mode == "replace" else "dynamic")
     .partitionBy(*partition_by).parquet(path))


def read_partitioned(spark: SparkSession, path: str, business_year: int | None = None,
                     state: str | None = None) -> DataFrame:
    """Read back, with literal filters on partition columns (pruned at listing)."""
    df = spark.read.parquet(path)
    if business_year is not None:
        df = df.where(F.col("business_year") == F.lit(int(business_year)))
    if state is not None:
        df = df.where(F.col("state_code") == F.lit(state))
    return df


def shared_path(spark: SparkSession, name: str, source: str = "") -> str:
    """A folder under the shared ``spark.checkpoint.dir``; the same one in every process for the same
    ``source``, so that a rerun replaces it."""
    from ..session import checkpoint_dir
    tag = f"_{hashlib.sha1(source.encode()).hexdigest()[:12]}" if source else ""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}{tag}"
