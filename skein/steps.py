"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def distributed(spark: SparkSession, path: str) -> str:
    """``path``, unless its file system is a machine's own, which executors elsewhere do not share."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file":
        raise ValueError(f"{path} is on one machine only: name a shared folder in spark.checkpoint.dir")
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where the session names none: one of the warehouse's, which must not be local, or a temporary one if master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.startswith("local"):
            found = tempfile.mkdtemp(prefix="skein-")
            atexit.register(shutil.rmtree, found, ignore_errors=True)
        else:
            found = distributed(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/skein-steps")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet in the shared folder and read back, and where it stands."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written and read back: cuts lineage and survives lost executors."""
    return written(df, tag)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a written step that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
