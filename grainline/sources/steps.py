"""Stored intermediate tables of a run: step boundaries with a recovery point, a scope and a release.

A step's rows are written once to the shared ``spark.checkpoint.dir`` and read by every later step, so the plan behind them
runs once and lineage ends in files that outlive executors. Tables live in the folder of their run. A run that is given the
id of an earlier one that failed finds that run's finished tables (Spark marks a complete one with ``_SUCCESS``) and goes on
from there; an unfinished table is written anew. ``release`` drops the run's views and deletes its folder; as a context
manager, a run releases itself if it succeeds and keeps its tables if it fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Runs of this process whose tables are still stored: id -> Steps.
LIVE: dict[str, Steps] = {}


class Steps:
    """The stored tables of one run. ``run_id``: a new one by default, so that runs never share tables by accident."""

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        from ..session import checkpoint_dir
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/grainline-steps/{self.run_id}"
        self._tables: dict[str, DataFrame] = {}
        self._views: set[str] = set()
        LIVE[self.run_id] = self

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The rows of ``build()``, stored under ``name``; computed only if this run has not finished them yet."""
        if name not in self._tables:
            path = f"{self.root}/{name}"
            done, fs = file_system(self.spark, f"{path}/_SUCCESS")
            if fs.exists(done):
                self._tables[name] = self.spark.read.parquet(path)
            else:
                df = build()
                df.write.mode("overwrite").parquet(path)
                self._tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._tables[name]

    def view(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The same, also as the session's temp view ``name``."""
        stored = self.table(name, build)
        stored.createOrReplaceTempView(name)
        self._views.add(name)
        return stored

    def release(self) -> None:
        """Drop this run's views and delete its tables; frames that read them must be done."""
        for name in self._views:
            self.spark.catalog.dropTempView(name)
        folder, fs = file_system(self.spark, self.root)
        fs.delete(folder, True)
        self._tables.clear()
        self._views.clear()
        LIVE.pop(self.run_id, None)

    def __enter__(self) -> Steps:
        return self

    def __exit__(self, failed, *_) -> None:
        if failed is None:
            self.release()


def release_all() -> None:
    """Release every run of this process that still has tables stored."""
    for run in list(LIVE.values()):
        run.release()


def file_system(spark: SparkSession, path: str):
    """The path and its Hadoop file system, whatever store it is in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
