"""Published tables: immutable partition folders, and numbered manifests that name the current ones.

    <path>/data/business_year=2024/state_code=TX/__v=<write>/part-*.parquet
    <path>/manifests/00000003.json

A write puts its rows into new folders that no manifest names, so readers do not see them; then one rename makes the next
manifest appear, and with it the whole new table. A write that fails leaves the old table as it was. Two writers at
once: the second finds its number taken and fails. Part of the table can be replaced: the other partitions' folders go on
into the next manifest untouched. Readers take the latest manifest and list nothing but the folders it names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .steps import file_system

_NULL = "__HIVE_DEFAULT_PARTITION__"
_WRITE = "__v"


class PublishConflict(RuntimeError):
    """Another writer published first; read again and decide anew."""


@dataclass
class Manifest:
    version: int
    schema: str
    folders: list[str]                      # relative to the table's data folder
    notes: dict = field(default_factory=dict)


def _text(value) -> str:
    return _NULL if value is None else str(value)


def _values(folder: str) -> dict[str, str]:
    """Partition column -> value as text, of a folder ``a=1/b=x/__v=...``."""
    parts = (p.split("=", 1) for p in folder.split("/"))
    return {unquote(k): v if v == _NULL else unquote(v) for k, v in parts if k != _WRITE}


def _within(folder: str, units: Sequence[Mapping[str, object]]) -> bool:
    have = _values(folder)
    return any(all(have[k] == _text(v) for k, v in unit.items()) for unit in units)


class Published:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ("business_year", "state_code")):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    def _names(self, pattern: str) -> list[str]:
        p, fs = file_system(self.spark, f"{self.path}/{pattern}")
        found = fs.globStatus(p)
        return sorted(str(s.getPath().toString()) for s in found) if found else []

    def current(self) -> Manifest | None:
        """The latest manifest; None before the first publication."""
        names = self._names("manifests/*.json")
        if not names:
            return None
        text = self.spark.read.text(names[-1], wholetext=True).first().value
        return Manifest(**json.loads(text))

    def publish(self, df: DataFrame, replacing: Sequence[Mapping[str, object]] | None = None, notes: dict | None = None) -> Manifest:
        """Make ``df`` the table; with ``replacing`` (partition values), only the partitions that match one of these, and
        ``df`` must hold no rows of others. Returns the new manifest."""
        before = self.current()
        # files hold nulls anyway: whether a column may be null is no part of the contract
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]).json()
        if replacing is not None and before is not None and json.loads(before.schema) != json.loads(schema):
            raise ValueError("a partial replacement must have the table's schema")
        write = uuid.uuid4().hex
        (df.withColumn(_WRITE, F.lit(write)).hint("rebalance", *self.partition_by).write.mode("append")
         .partitionBy(*self.partition_by, _WRITE).parquet(f"{self.path}/data"))
        levels = "/".join("*" * len(self.partition_by))
        new = [n[n.rindex("/data/") + 6:] for n in self._names(f"data/{levels}/{_WRITE}={write}")]
        kept: list[str] = []
        if replacing is not None:
            if any(not _within(n, replacing) for n in new):
                raise ValueError("rows outside the partitions to replace")
            kept = [f for f in (before.folders if before else []) if not _within(f, replacing)]
        manifest = Manifest((before.version if before else 0) + 1, schema, sorted(kept + new), notes or {})
        self._commit(manifest)
        return manifest

    def _commit(self, manifest: Manifest) -> None:
        name = f"{self.path}/manifests/{manifest.version:08d}"
        claim, fs = file_system(self.spark, f"{name}.claim")
        draft, _ = file_system(self.spark, f"{self.path}/manifests/.{uuid.uuid4().hex}")
        fs.mkdirs(claim.getParent())
        if not fs.createNewFile(claim):                             # one writer gets the number
            raise PublishConflict(f"version {manifest.version} of {self.path} is taken")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest.__dict__).encode()))
        out.close()
        if not fs.rename(draft, file_system(self.spark, f"{name}.json")[0]):
            raise PublishConflict(f"version {manifest.version} of {self.path} could not be made current")

    def read(self, **equal) -> DataFrame:
        """The current table; ``equal`` picks partitions from the manifest, before anything is listed or read."""
        manifest = self.current()
        if manifest is None:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        folders = [f for f in manifest.folders if not equal or _within(f, [equal])]
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/data"
        stored = T.StructType([*schema.fields, T.StructField(_WRITE, T.StringType())])
        return self.spark.read.schema(stored).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).select(*schema.fieldNames())

    def vacuum(self) -> int:
        """Delete the folders that the current manifest does not name (older versions, failed writes); no writer may be at
        work. Returns their number."""
        manifest = self.current()
        named = set(manifest.folders) if manifest else set()
        levels = "/".join("*" * len(self.partition_by))
        gone = 0
        for name in self._names(f"data/{levels}/{_WRITE}=*"):
            if name[name.rindex("/data/") + 6:] not in named:
                p, fs = file_system(self.spark, name)
                fs.delete(p, True)
                gone += 1
        return gone
