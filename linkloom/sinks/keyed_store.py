"""A table stored in hash buckets of its key, of which an upsert rewrites only those it touches.

``path/data/<generation>/_bucket=<n>`` holds the rows of a bucket, ``path/manifest/<version>.json``
says which generation each bucket is to be read from.  An upsert reads the touched buckets, writes
them anew as one generation and then creates the next manifest, which must not be there yet.  So
readers see all of an upsert or nothing of it, a failed one leaves only files that no manifest
names, and of two at the same time the second one fails.  ``vacuum`` deletes what the newest
manifest does not name.

The driver holds the manifest, a number a bucket.  Choose buckets so that one is about a Parquet file,
or fewer rows where upserts are small beside the table: changed keys touch as many buckets at most.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.session import discard, stored

_BUCKET = "_bucket"


@dataclass(frozen=True)
class KeyedStore:
    """One version of a store; a change gives the next one and leaves this one readable until ``vacuum``."""

    spark: SparkSession
    path: str
    key: str
    buckets: int
    schema: T.StructType
    version: int
    generations: dict[int, str]
    #: Buckets that the change leading to this version wrote.
    rewritten: int = 0

    # -- versions

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int) -> KeyedStore:
        """Store ``df`` at a path that holds no store yet; its keys must be there and be different."""
        if buckets < 1:
            raise ValueError("a store needs a bucket")
        empty = cls(df.sparkSession, path, key, buckets, df.schema, 0, {})
        return empty.upsert(df, lambda old, new: new)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedStore:
        """The newest version."""
        system, folder = _hadoop(spark, f"{path}/manifest")
        versions = [int(f.getPath().getName().removesuffix(".json")) for f in system.listStatus(folder)]
        version = max(versions)
        told = json.loads(spark.read.text(f"{path}/manifest/{version}.json", wholetext=True).first()[0])
        generations = {b: name for name, held in told["generations"].items() for b in held}
        return cls(spark, path, told["key"], told["buckets"], T.StructType.fromJson(told["schema"]), version, generations)

    def _commit(self, generations: dict[int, str], rewritten: int) -> KeyedStore:
        held: dict[str, list[int]] = {}
        for bucket, name in sorted(generations.items()):
            held.setdefault(name, []).append(bucket)
        told = {"key": self.key, "buckets": self.buckets, "schema": self.schema.jsonValue(), "generations": held}
        version = self.version + 1
        system, file = _hadoop(self.spark, f"{self.path}/manifest/{version}.json")
        # written beside and moved, so that no reader finds half a manifest; a version that is there stays
        _, draft = _hadoop(self.spark, f"{self.path}/draft-{uuid.uuid4().hex}")
        out = system.create(draft, False)
        out.write(bytearray(json.dumps(told), "utf-8"))
        out.close()
        system.mkdirs(file.getParent())
        if system.exists(file) or not system.rename(draft, file):
            system.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.path} is there already; open the store again and repeat the change")
        return KeyedStore(self.spark, self.path, self.key, self.buckets, self.schema, version, generations, rewritten)

    # -- rows

    def _bucket_of(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _rows(self, buckets: Sequence[int]) -> DataFrame:
        folders = [f"{self.path}/data/{self.generations[b]}/{_BUCKET}={b}" for b in buckets if b in self.generations]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        return self._rows(sorted(self.generations))

    def lookup(self, keys: Sequence) -> DataFrame:
        """The rows of a few keys; only their buckets are read, and in them by the keys' statistics."""
        wanted = self.spark.createDataFrame([(k,) for k in keys], T.StructType([self.schema[self.key]]))
        buckets = sorted({r[0] for r in wanted.select(self._bucket_of()).collect()})
        return self._rows(buckets).filter(F.col(self.key).isin(list(keys)))

    def upsert(self, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> KeyedStore:
        """The store with ``merge(old rows, rows)`` in the buckets of the keys of ``rows``.

        ``merge`` gets the old rows of those buckets only and must treat each key by itself.
        """
        new = stored(rows.select(*self.schema.names).withColumn(_BUCKET, self._bucket_of()))
        touched = sorted(r[0] for r in new.select(_BUCKET).distinct().collect())
        if not touched and self.version:
            return self
        merged = merge(self._rows(touched), new.drop(_BUCKET)).select(*self.schema.names).withColumn(_BUCKET, self._bucket_of())
        generation = uuid.uuid4().hex
        laid_out = merged.repartition(_BUCKET).sortWithinPartitions(_BUCKET, self.key)
        laid_out.write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{generation}")
        discard(new)
        generations = {b: g for b, g in self.generations.items() if b not in set(touched)}
        # a bucket whose rows are all gone has no folder
        generations |= dict.fromkeys(self._written(generation), generation)
        return self._commit(generations, len(touched))

    def _written(self, generation: str) -> list[int]:
        system, folder = _hadoop(self.spark, f"{self.path}/data/{generation}")
        names = [f.getPath().getName() for f in system.listStatus(folder)]
        return [int(n.removeprefix(f"{_BUCKET}=")) for n in names if n.startswith(f"{_BUCKET}=")]

    def vacuum(self) -> int:
        """Delete generations and manifests that this version, which must be the newest, does not need."""
        if KeyedStore.open(self.spark, self.path).version != self.version:
            raise RuntimeError("only the newest version tells what is not needed")
        needed = set(self.generations.values())
        system, data = _hadoop(self.spark, f"{self.path}/data")
        gone = [f.getPath() for f in system.listStatus(data) if f.getPath().getName() not in needed]
        _, manifests = _hadoop(self.spark, f"{self.path}/manifest")
        gone += [f.getPath() for f in system.listStatus(manifests) if f.getPath().getName() != f"{self.version}.json"]
        for old in gone:
            system.delete(old, True)
        return len(gone)


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder
