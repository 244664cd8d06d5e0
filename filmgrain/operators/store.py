"""A stored collection that is changed by key: only the buckets that a batch touches are rewritten.

Rows lie in a fixed number of buckets by a hash of their key. A manifest lists the folder of
every bucket and the names of the batches that made it; the newest manifest is the
collection. A merge reads and rewrites touched buckets into fresh folders and then adds one
manifest, in one rename. So a run that fails leaves the collection as it was, and a batch
that is run again finds its name and changes nothing. One writer at a time is assumed: a
manifest number that is taken stops the merge.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

@dataclass(frozen=True)
class Manifest:
    """One state: folders by bucket (none for an empty one), schema, batches applied."""

    number: int
    key: str
    buckets: int
    schema: str
    folders: dict[str, str]
    batches: tuple[str, ...]


class Collection:
    """Rows with a unique key below ``path``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # states

    def _numbers(self) -> list[int]:
        folder = self._at(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self) -> Manifest:
        number = self._numbers()[-1]
        lines = self.spark.read.text(f"{self.path}/manifests/{number:012}.json", wholetext=True).collect()
        told = json.loads(lines[0][0])
        return Manifest(**{**told, "batches": tuple(told["batches"])})

    def _commit(self, state: Manifest) -> None:
        folder = f"{self.path}/manifests"
        self._fs.mkdirs(self._at(folder))
        draft, final = self._at(f"{folder}/.{uuid.uuid4().hex}"), self._at(f"{folder}/{state.number:012}.json")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state.__dict__).encode()))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"another writer has made state {state.number}")

    # rows

    def _bucket(self, key: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, key: str, buckets: int) -> dict[str, str]:
        """Folders of the buckets that ``rows`` fill."""
        label = f"rows/{uuid.uuid4().hex}"
        rows.withColumn("bucket", self._bucket(key, buckets)).repartition(buckets, "bucket").write.partitionBy(
            "bucket").parquet(f"{self.path}/{label}")
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at(f"{self.path}/{label}"))]
        return {n.removeprefix("bucket="): f"{label}/{n}" for n in found if n.startswith("bucket=")}

    def create(self, rows: DataFrame, key: str = "_id", buckets: int | None = None) -> Collection:
        """The first state, in as many buckets as shuffles have parts; ``bucket`` is no name for a column."""
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if "bucket" in rows.columns:
            raise ValueError("a column is called bucket")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        self._commit(Manifest(0, key, buckets, schema.json(), self._write(rows, key, buckets), ()))
        return self

    def read(self, only: list[str] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        state = self.manifest()
        schema = T.StructType.fromJson(json.loads(state.schema))
        folders = [f"{self.path}/{f}" for b, f in sorted(state.folders.items()) if only is None or b in only]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def merge(self, changes: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], batch: str) -> bool:
        """Apply ``change(rows, changes)`` to the touched buckets as ``batch``; False if that was done before.

        ``change`` must keep the columns, and must neither add nor drop a key outside the
        buckets of ``changes``. The numbers of the touched buckets are all that the driver sees.
        """
        state = self.manifest()
        if batch in state.batches:
            return False
        touched = sorted(str(r[0]) for r in changes.select(self._bucket(state.key, state.buckets)).distinct().collect())
        fresh = self._write(change(self.read(touched), changes).select(
            *[f["name"] for f in json.loads(state.schema)["fields"]]), state.key, state.buckets) if touched else {}
        folders = {b: f for b, f in state.folders.items() if b not in touched} | fresh
        self._commit(Manifest(state.number + 1, state.key, state.buckets, state.schema, folders, (*state.batches, batch)))
        return True

    def clear(self) -> int:
        """Delete row folders that the newest state does not name, those of failed runs included; how many."""
        named, gone = set(self.manifest().folders.values()), 0
        for label in self._fs.listStatus(self._at(f"{self.path}/rows")):
            run = f"rows/{label.getPath().getName()}"
            for folder in self._fs.listStatus(label.getPath()):
                name = folder.getPath().getName()
                if name.startswith("bucket=") and f"{run}/{name}" not in named:
                    self._fs.delete(folder.getPath(), True)
                    gone += 1
        return gone
