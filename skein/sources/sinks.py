"""Writers: full refresh, checked refresh, upsert, single-file extracts, reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import unique
from ..operators.rows import upsert


def refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replaces a Parquet table; a second run gives the same table."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def checked_refresh(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Replaces the table, then holds it to its key; returns what was written."""
    refresh(df, path)
    out = df.sparkSession.read.parquet(path)
    found = unique(out, keys, "key").first()
    if not found["passed"]:
        raise ValueError(f"{found['unexpected_count']} rows repeat a key of {keys}")
    return out


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> int:
    """Merges new rows into a Parquet table by key; returns how many were new or had another value.

    The merged table is written beside the old one, which then moves aside by a rename, and the new one into its place by
    another: a failure leaves one of them whole, and the next call puts the old one back if it finds the place empty. Large tables, and
    readers that must never find the place empty, go by ``published.Publication``, which rewrites only what changes.
    """
    path = path.rstrip("/")
    at = lambda suffix: spark._jvm.org.apache.hadoop.fs.Path(path + suffix)
    fs = at("").getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at("")) and fs.exists(at(".old")):
        fs.rename(at(".old"), at(""))
    old = spark.read.parquet(path)
    rest = [c for c in old.columns if c not in keys]
    same = old.select(*keys, F.struct(*rest, F.lit(1)).alias("__old")).join(new.select(*keys, F.struct(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in rest], F.lit(1)).alias("__new")), keys)
    changed = new.count() - same.filter(F.col("__old").eqNullSafe(F.col("__new"))).count()
    if changed:
        refresh(upsert(old, new, keys), path + ".next")
        fs.delete(at(".old"), True)
        if not (fs.rename(at(""), at(".old")) and fs.rename(at(".next"), at(""))):
            raise RuntimeError(f"{path} could not be replaced")
        fs.delete(at(".old"), True)
        spark.catalog.refreshByPath(path)
    return changed


def has_rows(df: DataFrame, expected: int) -> bool:
    """Whether a load can be skipped: the table has what is expected already."""
    return df.limit(expected).count() >= expected


def extract(df: DataFrame, folder: str) -> None:
    """One CSV with a header, for a small summary table; nulls are empty."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(folder)


def report(values: dict, path: str) -> None:
    """A JSON report of collected aggregates."""
    Path(path).write_text(json.dumps(values, indent=2, default=str) + "\n")
