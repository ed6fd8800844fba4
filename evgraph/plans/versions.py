"""Versions of a set of tables: data is staged under names of its own, and one rename of a small file makes it visible."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has published first."""


class Versions:
    """A folder of staged data and of manifests, one for each version.

    A version is whole or isn't there: readers go by the manifest alone, and a manifest is renamed to its name, which fails where
    there is one, so of two writers one has to begin anew. What a failed writer has staged is never read. Versions stay readable
    until `drop_before` forgets them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        fs, place = self._fs(), self._path("_versions")
        if not fs.exists(place):
            return []
        return sorted(int(n.removesuffix(".json")) for s in fs.listStatus(place) if (n := s.getPath().getName()).endswith(".json") and not n.startswith("."))

    def latest(self) -> int:
        """The newest version, 0 where none is published."""
        return max(self.numbers(), default=0)

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        """What a version consists of; nothing before the first."""
        version = self.latest() if version is None else version
        if version == 0:
            return {}
        stream = self._fs().open(self._path(f"_versions/{version:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def stage(self) -> str:
        """The name of a new folder for data, relative to the root."""
        return f"data/{uuid.uuid4().hex}"

    def write(self, frame: DataFrame, name: str, *partitions: str) -> None:
        frame.write.partitionBy(*partitions).parquet(f"{self.root}/{name}")

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(f"{self.root}/{name}")

    def publish(self, manifest: dict[str, Any], base: int) -> int:
        """Makes a version that follows `base`; Conflict if there is one already."""
        jvm, version = self.spark._jvm, base + 1
        fs, hidden, goal = self._fs(), self._path(f"_versions/.{uuid.uuid4().hex}.json"), self._path(f"_versions/{version:08d}.json")
        if fs.exists(goal):
            raise Conflict(f"version {version} is there already")
        stream = fs.create(hidden, False)
        try:
            stream.write(json.dumps(manifest, sort_keys=True).encode())
        finally:
            stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(goal).toUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(hidden), fs.makeQualified(goal), options)
        except Exception as e:
            fs.delete(hidden, False)
            raise Conflict(f"version {version} is there already") from e
        return version

    def drop_before(self, version: int) -> None:
        """Forgets the manifests before a version, and the data that no later one names."""
        fs = self._fs()
        kept = "".join(json.dumps(self.manifest(v)) for v in self.numbers() if v >= version)
        for v in self.numbers():
            if v < version:
                fs.delete(self._path(f"_versions/{v:08d}.json"), False)
        if fs.exists(self._path("data")):
            for s in fs.listStatus(self._path("data")):
                if f"data/{s.getPath().getName()}" not in kept:
                    fs.delete(s.getPath(), True)
