"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a grouped minimum joined back; the number of steps grows with the logarithm of the
longest path. A node never gathers its neighbours: minima are combined before they move, and a node's
links meet its minimum in ``DEALT`` tasks, by a hash of their other ends. As the minima are dealt anew for
that join, adaptive execution can split a hub's links further, however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import discard, written

DEALT = 8


def _star(links: DataFrame, large: bool, dealt: int) -> DataFrame:
    """Links each node's larger (or not larger) neighbours to its least neighbour or itself."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    parts = F.sequence(F.lit(0).cast("long"), F.lit(dealt - 1).cast("long"))
    joined = both.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(dealt))).join(least.withColumn("part", F.explode(parts)), ["a", "part"])
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame, dealt: int = DEALT) -> DataFrame:
    """(node, component) for every node of ``links`` (long columns a and b); component is its least node.

    Null ends and links of a node to itself are left out; repeated links count once; an empty table
    gives an empty result. Every step is written to the shared folder, so lost executors cost one
    step, and the step before it is deleted. Steps go on until nothing changes.
    """
    spark = links.sparkSession
    now, path = written(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").distinct(), "links")
    last = None
    while True:
        after, place = written(_star(_star(now, True, dealt), False, dealt), "stars")
        discard(spark, path)
        now, path = after, place
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == last:
            break
        last = tuple(sums)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
