"""Written intermediate tables in the folder all executors share, and bounded deterministic samples."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir`` (set by the cluster; a scratch folder in tests)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/grainline-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    small_batches(spark)
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, key: list, rows: int):
    """The ``rows`` rows with the smallest hash of ``key``: the same rows on every run, whatever the partitions.

    For fitting models only. Returns collected rows (the bound is the caller's documented parameter)."""
    return df.withColumn("__h", F.xxhash64(F.lit(7), *key)).orderBy("__h", *key).limit(rows).drop("__h").collect()


def row_key(docs: DataFrame) -> list[Column]:
    """Two columns that tell any two different (doc_id, text) rows apart."""
    return [F.coalesce("doc_id", F.lit(-1)).alias("__id"), F.xxhash64("doc_id", "text").alias("__hash")]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


#: Bytes of rows that go to a Python worker at once. Spark's own default (64 MB, doubled while it grows, for every running
#: task) would hold several hundred megabytes of an executor outside its heap.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let this session send texts to Python workers in batches of BATCH_BYTES, unless it already uses smaller ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def give_back() -> None:
    """Return freed memory to the system: a Python worker goes on to other tasks, and what its pools keep would stay."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, of at most ``rows`` rows and about ``size`` bytes of strings (one row at least)."""
    if not batch.num_rows:
        return
    upto = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            upto += pc.fill_null(pc.binary_length(column), 0).to_numpy()
    upto = np.cumsum(upto)
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right"))
        end = min(max(end, at + 1), at + rows)
        yield batch.slice(at, end - at)
        at = end


def add_columns(df: DataFrame, added: dict[str, str], compute: Callable[[pa.RecordBatch], list], drop: Sequence[str] = (),
                rows: int = 2048, size: int = 4 << 20) -> DataFrame:
    """``df`` with columns computed batch by batch (at most ``rows`` rows and about ``size`` bytes at once); its own columns of
    these names give way.

    ``added``: name -> Spark type; ``compute`` returns their values in this order. ``drop`` leaves out input columns."""
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in added and c not in drop]
    df = df.select(*kept, *[c for c in drop if c in df.columns])
    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"`{c}` {kind[c]}" for c in kept), *(f"`{k}` {t}" for k, t in added.items())])
    names, types = [*kept, *added], [_TYPES.get(t) for t in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, rows, size):
                new = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(compute(batch), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], names)
        give_back()

    return df.mapInArrow(run, schema)
