"""A table of rows by key that is updated in place, a version at a time.

Rows are dealt to ``parts`` by a hash of their key. An upsert reads and rewrites only the parts that its keys fall
into; all other files keep their names. A version is one small manifest that says which folder holds each part; it
appears by a rename that fails if another writer took the number first. Until then nothing that readers
see has changed, so a failed or abandoned write leaves at most folders that no manifest names, which ``vacuum``
removes. Older versions stay readable until then.

What reaches the driver is one entry per part, a number that is fixed when the store is made.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.sources.writers import upsert

PARTS = 64


class Conflict(RuntimeError):
    """Another writer committed first."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Files, through Hadoop, so that any store Spark reaches will do

    def _at(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _files(self):
        return self._at().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, at = self._files(), self._at(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []

    def _read_text(self, *names: str) -> str:
        stream = self._files().open(self._at(*names))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    # Versions

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json")]

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> dict:
        """What a version holds: ``version``, ``key``, ``parts``, ``schema``, and ``held``, (folder, rows) by part."""
        if version is None:
            version = max(self.versions(), default=None)
            if version is None:
                raise FileNotFoundError(f"no store at {self.path}")
        return json.loads(self._read_text("manifests", f"{version:012d}.json"))

    def _commit(self, manifest: dict) -> int:
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        temporary, final = self._at("manifests", f".{uuid.uuid4().hex}"), self._at("manifests", f"{manifest['version']:012d}.json")
        stream = self._files().create(temporary, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(temporary, final, gateway.new_array(rename, 0))  # without overwriting
        except Exception as error:
            self._files().delete(temporary, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {manifest['version']} of {self.path} exists already") from error
            raise
        return manifest["version"]

    # Rows

    @staticmethod
    def _part(key: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int")

    def _write(self, rows: DataFrame, key: str, parts: int) -> dict[str, list]:
        """Write rows by part below a new folder; (folder, rows) by part."""
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("_part", self._part(key, parts))
        dealt.hint("rebalance", "_part").write.partitionBy("_part").parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(f"{self.path}/{folder}")
        return {str(r[0]): [f"{folder}/_part={r[0]}", r[1]] for r in written.groupBy("_part").count().collect()}

    def _rows(self, manifest: Mapping, parts: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/{manifest['held'][p][0]}" for p in parts if p in manifest["held"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def create(self, rows: DataFrame, key: str, parts: int = PARTS) -> int:
        """Make the store; of rows with one key the largest counts. Fails if there is one already."""
        if self.exists():
            raise Conflict(f"a store exists at {self.path}")
        rows = upsert(rows.limit(0), rows, key)
        held = self._write(rows, key, parts)
        return self._commit({"version": 1, "key": key, "parts": parts, "schema": json.loads(rows.schema.json()), "held": held})

    def upsert(self, incoming: DataFrame, order: str | None = None) -> int:
        """Insert or replace by key and commit a new version. ``incoming`` is read twice: hand in a written table."""
        now = self.manifest()
        touched = [str(r[0]) for r in incoming.select(self._part(now["key"], now["parts"])).distinct().collect()]
        if not touched:
            return now["version"]
        names = T.StructType.fromJson(now["schema"]).fieldNames()
        merged = upsert(self._rows(now, touched), incoming.select(*names), now["key"], order)
        held = now["held"] | self._write(merged, now["key"], now["parts"])
        return self._commit(now | {"version": now["version"] + 1, "held": held})

    def read(self, version: int | None = None) -> DataFrame:
        found = self.manifest(version)
        return self._rows(found, sorted(found["held"], key=int))

    def count(self, version: int | None = None) -> int:
        """Rows of a version, from its manifest."""
        return sum(n for _, n in self.manifest(version)["held"].values())

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove all but the last ``keep`` versions, and folders that none of those names; the folders removed.

        Not while a write is under way: its folder isn't named yet.
        """
        files, versions = self._files(), self.versions()
        kept = versions[-keep:]
        named = {place.rsplit("/", 1)[0] for v in kept for place, _ in self.manifest(v)["held"].values()}
        for v in set(versions) - set(kept):
            files.delete(self._at("manifests", f"{v:012d}.json"), False)
        gone = [n for n in self._names("data") if f"data/{n}" not in named]
        for name in gone:
            files.delete(self._at("data", name), True)
        return gone
