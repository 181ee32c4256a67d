"""Session settings, and shipping the package to executors that do not have it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(app: str = "skein", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC, adaptive execution and skew handling; sizes are left to the cluster unless given."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="skein-src-")
    path = os.path.join(folder, "skein-src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
        for p in sorted(root.parent.glob("*.py")):
            if p.name in ("corpus_pipeline.py", "__spark_entry__.py"):
                z.write(p, p.name)
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
