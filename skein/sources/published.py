"""Several tables published at once: readers see all of a version or none of it.

A version's tables are written beside the older ones, in folders of their own, and checked as they stand there. Then one small
manifest, which says what folders make up each table, is written under a temporary name and renamed to the next number: that
rename is the publication. Readers go by the manifest with the greatest number; a failure at any step before leaves it as it was.

A table with a key is stored in buckets by the key's hash, a folder each, so the key tells where its row is. An upsert
reads and rewrites the buckets of its rows only; all other folders go into the next manifest as they are.

Cases: one writer at a time (a second one that finds its number taken is told so); null parts of a key are not allowed; a key that repeats
within a table or an upsert is refused; an upsert that changes nothing publishes nothing; empty tables are published with their columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import gate
from ..steps import discard, written

#: Buckets of a table with a key, where the caller does not say: for tables of some gigabytes.
BUCKETS = 64
_BUCKET, _SIDE = "__bucket", "__side"


class Publication:
    """The published tables under one folder of any file system that Spark writes."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # the manifest

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, folder = self._fs(), self._path("manifests")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """What a version (the last one if not given) holds; without any: no tables, version 0."""
        every = self.versions()
        if not every:
            return {"version": 0, "tables": {}}
        stream = self._fs().open(self._path(f"manifests/v{every[-1] if version is None else version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> int:
        fs, version = self._fs(), manifest["version"]
        aside, final = self._path(f"manifests/.{uuid.uuid4().hex}"), self._path(f"manifests/v{version:012d}.json")
        stream = fs.create(aside, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if fs.exists(final) or not fs.rename(aside, final):
            fs.delete(aside, False)
            raise RuntimeError(f"version {version} was published by another writer")
        return version

    # tables

    def _bucket(self, keys: list[str], buckets: int):
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")

    def _write(self, name: str, df: DataFrame, keys: list[str], buckets: int) -> dict[str, str]:
        """The folders, under the root, of ``df`` as written: by bucket, or one."""
        folder = f"tables/{name}/{uuid.uuid4().hex}"
        if not keys:
            df.write.parquet(f"{self.root}/{folder}")
            return {"all": folder}
        df.withColumn(_BUCKET, self._bucket(keys, buckets)).repartition(F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
        fs = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(self._path(folder)) if s.isDirectory()]
        return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith(f"{_BUCKET}=")}

    def _read(self, entry: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        folders = [f for b, f in entry["folders"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version)["tables"][name])

    def _keyed(self, df: DataFrame, keys: list[str], what: str) -> None:
        """Raises if a key has a null part or repeats."""
        if not keys:
            return
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        found = df.groupBy(*keys).count().filter((F.col("count") > 1) | null).limit(1).collect()
        if found:
            raise ValueError(f"{what}: the key {keys} is null or repeats, as in {found[0].asDict()}")

    def publish(self, tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None, checks: Callable[[dict[str, DataFrame]], DataFrame] | None = None, *, buckets: int = BUCKETS) -> int:
        """Replaces ``tables``, all at once, and returns the version; published tables that are not named stay.

        ``checks`` gets the tables as they were written and returns a report as of ``quality``; if a hard check failed, nothing is published.
        """
        manifest, keys = self.manifest(), keys or {}
        made = {}
        for name, df in tables.items():
            own = keys.get(name, [])
            made[name] = {"schema": json.loads(df.schema.json()), "keys": own, "buckets": buckets, "folders": self._write(name, df, own, buckets)}
        stand = {name: self._read(entry) for name, entry in made.items()}
        for name, entry in made.items():
            self._keyed(stand[name], entry["keys"], name)
        if checks:
            gate(checks(stand))
        return self._commit({"version": manifest["version"] + 1, "tables": manifest["tables"] | made})

    def upsert(self, name: str, new: DataFrame) -> tuple[int, int]:
        """Inserts and updates rows by the table's key; returns how many were inserted, and how many had another value.

        ``new`` has the table's columns. Only buckets that one of its rows falls in are read, and only those with a change are written.
        """
        manifest = self.manifest()
        entry = manifest["tables"][name]
        keys, schema = entry["keys"], T.StructType.fromJson(entry["schema"])
        if not keys:
            raise ValueError(f"{name} has no key")
        rest = [c for c in schema.names if c not in keys]
        rows, aside = written(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]), "upsert")
        self._keyed(rows, keys, f"rows for {name}")
        touched = [str(r[0]) for r in rows.select(self._bucket(keys, entry["buckets"]).alias("b")).distinct().collect()]  # at most the buckets
        old = self._read(entry, touched)
        both = old.select(*keys, F.struct(*rest, F.lit(1).alias(_SIDE)).alias("old")).join(rows.select(*keys, F.struct(*rest, F.lit(1).alias(_SIDE)).alias("new")), keys, "full")
        kind = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNotNull() & ~F.col("old").eqNullSafe(F.col("new")), "changed").otherwise("kept")
        merged, beside = written(both.select(*keys, *[F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in rest], kind.alias(_SIDE)), "merged")
        counts: dict[str, int] = {}
        moved: set[int] = set()
        for r in merged.groupBy(self._bucket(keys, entry["buckets"]).alias("b"), _SIDE).count().collect():  # three rows a bucket at most
            counts[r[_SIDE]] = counts.get(r[_SIDE], 0) + r["count"]
            if r[_SIDE] != "kept":
                moved.add(r["b"])
        if moved:
            some = merged.filter(self._bucket(keys, entry["buckets"]).isin(sorted(moved))).select(*schema.names)
            folders = entry["folders"] | self._write(name, some, keys, entry["buckets"])
            self._commit({"version": manifest["version"] + 1, "tables": manifest["tables"] | {name: entry | {"folders": folders}}})
        for path in (aside, beside):
            discard(self.spark, path)
        return counts.get("inserted", 0), counts.get("changed", 0)

    def clean(self, keep: int = 2) -> int:
        """Deletes folders and manifests that none of the last ``keep`` versions names, those of failed runs too; returns how many folders went."""
        fs, every = self._fs(), self.versions()
        kept = {f for v in every[-keep:] for t in self.manifest(v)["tables"].values() for f in t["folders"].values()}
        gone = 0
        tables = self._path("tables")
        for table in fs.listStatus(tables) if fs.exists(tables) else []:
            for write in fs.listStatus(table.getPath()):
                folder = f"tables/{table.getPath().getName()}/{write.getPath().getName()}"
                if folder in kept:
                    continue
                parts = [f"{folder}/{s.getPath().getName()}" for s in fs.listStatus(write.getPath()) if s.isDirectory()]
                if any(p in kept for p in parts):
                    for p in parts:
                        if p not in kept:
                            gone += bool(fs.delete(self._path(p), True))
                else:
                    gone += bool(fs.delete(write.getPath(), True))
        for v in every[:-keep]:
            fs.delete(self._path(f"manifests/v{v:012d}.json"), False)
        return gone
