"""Sharding by size-tiered compaction, in DataFrame operations and the Hadoop file API only.

An arrival is appended as small immutable shards. Compaction merges similarly sized shards (sizes within
one power of ``fan_in``) into files of at most about ``target_bytes``; a merged file that reaches half of the target is final.
Shards are never changed: every append or compaction commits a new manifest version that lists the
live shards, and old shards stay until vacuum() so that readers of older versions are not disturbed.

The commit is one atomic step: the manifest is written under a temporary name and renamed to its version's name, and a
rename onto an existing version fails, so of two writers one wins and the other sees Conflict. Jobs that fail or
executors that are lost leave only files that no manifest names.

Cases: any schema (columns are stored as they come; nulls and repeated rows stay), an empty arrival commits a
version without new shards, and rows of any length go whole to one shard. Columns may have any names.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh


class Conflict(RuntimeError):
    """Another writer committed this version."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fan_in: int = 4):
        self.spark, self.root, self.target, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self._jvm = spark._jvm
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    # manifests
    def versions(self) -> list[int]:
        found = self._fs.listStatus(self._path(f"{self.root}/manifests"))
        names = [x.getPath().getName() for x in found]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        have = self.versions()
        if not have:
            return {"version": 0, "schema": None, "shards": []}
        stream = self._fs.open(self._path(f"{self.root}/manifests/v{(version or have[-1]):09d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, based_on: int, schema: str, shards: list[dict]) -> dict:
        body = {"version": based_on + 1, "schema": schema, "shards": shards}
        final = self._path(f"{self.root}/manifests/v{based_on + 1:09d}.json")
        temporary = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(body).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(temporary, final):
            self._fs.delete(temporary, False)
            raise Conflict(f"version {based_on + 1} exists")
        return body

    # shards
    def _files(self, folder: str) -> list[dict]:
        found = self._fs.listStatus(self._path(folder))
        parts = [(x.getPath().getName(), x.getLen()) for x in found]
        return [{"path": f"{folder}/{name}", "bytes": size} for name, size in sorted(parts) if name.startswith("part-")]

    def append(self, arrival: DataFrame) -> dict:
        """Adds the rows as small shards, one per task: no shuffle."""
        now = self.manifest()
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        arrival.write.parquet(folder)
        return self.commit(now["version"], arrival.schema.json(), now["shards"] + self._files(folder))

    def tier(self, size: int) -> int:
        """0 for the smallest shards; a tier's shards differ in size by at most ``fan_in`` times."""
        level, bound = 0, max(1, self.target // self.fan_in**6)
        while size > bound:
            level, bound = level + 1, bound * self.fan_in
        return level

    def plan(self, shards: list[dict]) -> list[dict]:
        """Shards to merge: those below half of the target in tiers that hold ``fan_in`` of them, or enough for a final file."""
        tiers: dict[int, list[dict]] = {}
        for shard in shards:
            if shard["bytes"] * 2 < self.target:
                tiers.setdefault(self.tier(shard["bytes"]), []).append(shard)
        full = lambda run: len(run) >= self.fan_in or len(run) > 1 and sum(x["bytes"] for x in run) * 2 >= self.target
        return [x for level in sorted(tiers) if full(tiers[level]) for x in tiers[level]]

    def compact(self) -> dict:
        """One round in one narrow job without a shuffle: the scan packs the planned shards, largest first, into partitions of
        about ``target_bytes``, and each partition becomes one file. The plan has one leaf, however many shards it reads."""
        now = self.manifest()
        merge = self.plan(now["shards"])
        if not merge:
            return now
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        packing = {"spark.sql.files.maxPartitionBytes": str(self.target), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
        before = {k: self.spark.conf.get(k, None) for k in packing}
        try:
            for k, v in packing.items():
                self.spark.conf.set(k, v)
            merged = self.spark.read.schema(self._schema(now)).parquet(*[x["path"] for x in merge])
            merged.write.option("maxRecordsPerFile", 0).parquet(folder)
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        gone, made = {x["path"] for x in merge}, self._files(folder)
        if len(made) >= len(merge):  # nothing was won: the session packs less than the target into a partition
            return now
        return self.commit(now["version"], now["schema"], [x for x in now["shards"] if x["path"] not in gone] + made)

    def settle(self) -> dict:
        """Rounds until no tier has shards to merge."""
        while True:
            before = self.manifest()["version"]
            if (after := self.compact())["version"] == before:
                return after

    def _schema(self, manifest: dict):
        from pyspark.sql.types import StructType

        return StructType.fromJson(json.loads(manifest["schema"]))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the last by default) with the shard each row came from in ``_shard`` (with more underscores
        where a stored column begins so)."""
        now = self.manifest(version)
        if now["schema"] is None:
            raise ValueError("nothing was appended yet")
        schema, paths = self._schema(now), [x["path"] for x in now["shards"]]
        if not paths:
            rows, shard = self.spark.createDataFrame([], schema), F.lit(None).cast("string")
        else:
            rows, shard = self.spark.read.schema(schema).parquet(*paths), F.element_at(F.split(F.input_file_name(), "/"), -1)
        return rows.withColumn(fresh(rows, "_shard"), shard)

    def vacuum(self, least_age: float = 24 * 3600.0) -> int:
        """Deletes shards that older versions name and the last one doesn't, and files that no version names once they are
        ``least_age`` seconds old: younger ones may belong to a writer that hasn't committed yet. Returns how many."""
        versions = [self.manifest(v) for v in self.versions()]
        live = {x["path"] for x in versions[-1]["shards"]} if versions else set()
        named = {x["path"] for v in versions for x in v["shards"]}
        dead = 0
        for folder in self._fs.listStatus(self._path(f"{self.root}/data")):
            for file in self._fs.listStatus(folder.getPath()):
                path = f"{self.root}/data/{folder.getPath().getName()}/{file.getPath().getName()}"
                old = time.time() - file.getModificationTime() / 1000 > least_age
                if path not in live and (path in named or old):
                    self._fs.delete(file.getPath(), False)
                    dead += path.rpartition("/")[2].startswith("part-")
        return dead
