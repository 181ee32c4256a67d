"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same copy number ``target / source size``; its whole
part is certain, its fraction is rounded. Within a bucket of a source, documents are paired: words
move from one to the other, up or down at odds that keep each document's expected copies, until a
copy number is integral; the other goes on to the next pair. A bucket thus leaves one fractional
document at most. Buckets' leftovers meet in groups of ``fan_in`` and are paired again, level by
level, until one for each source is left, which a coin decides. As the words of a pair never
change, a source's taken words differ from its target by less than one document.

Cases: null text has size 0; a null source is a source of its own, last in order; documents of
size 0 take 0; repeated rows are documents of their own (equal rows of a bucket are interchangeable);
very long texts count whole; sources of equal room go by code point; an empty table gives an empty
result; other columns, also of the result's names, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import materialize, spread_join

WORD = r"[^\x20\x09-\x0D]+"
EDGE = 1e-9
#: Sources that one task takes in order.
PER_TASK = 100_000


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ordered(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """``df`` written in order, in ranges of about ``PER_TASK`` rows: ``__part`` numbers them and ``__at`` their rows."""
    out = df.repartitionByRange(max(1, rows // PER_TASK), *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    return materialize(out, "ordered").withColumn("__part", F.shiftright("__at", 33))


def _before(df: DataFrame, **sums: Column) -> DataFrame:
    """Adds each value's sum over all rows before: within the range, and over the ranges before, of which there are few."""
    over = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = df.groupBy("__part").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).select("__part", *[F.coalesce(F.sum(n).over(over), F.lit(0)).alias(f"__{n}") for n in sums])
    local = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumns({n: F.coalesce(F.sum(c).over(local), F.lit(0)) for n, c in sums.items()}).join(F.broadcast(ranges), "__part")
    return out.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop(*[f"__{n}" for n in sums])


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row for each source: its size, documents and target words.

    Shares follow the weights, dealt to the sources in code point order; what exceeds ``most``
    times a source's size goes to the others by weight. That fixed point is the level at which
    ``sum(min(most * size, level * weight))`` is the total, found by one ordered pass over the
    sources' rows (never over documents), in ranges, so that no task sees all sources.
    """
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "totals")
    rows, total = totals.agg(F.count("*"), F.sum("source_size")).first()
    placed = _before(_ordered(totals, rows, F.col("source").asc_nulls_last()), rank=F.lit(1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    placed = placed.select("source", "source_size", "n_docs", "rank", weight.alias("w"), (F.col("source_size") * most).cast("double").alias("room"))
    ratio = F.col("room") / F.col("w")
    placed = _before(_ordered(placed, rows, ratio.asc(), F.col("rank").asc()), filled=F.col("room"), passed=F.col("w"))
    every = placed.agg(F.sum("w")).first()[0] or 0.0
    placed = placed.withColumn("level", (F.lit(float(total or 0)) - F.col("filled")) / (F.lit(every) - F.col("passed")))
    full = ratio < F.col("level")
    level = placed.filter(~full).agg(F.min_by("level", F.struct(ratio.alias("ratio"), "rank"))).first()[0]
    return placed.select("source", "source_size", "n_docs", F.when(full, F.col("room")).otherwise(F.lit(level).cast("double") * F.col("w")).alias("target"))


def _pivot(seed: int, level: int, final: bool):
    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        p, size = rows["p"].to_numpy(float).copy(), rows["size"].to_numpy(float)
        key = f"{seed}|{level}|{rows['source'].iloc[0]}|{rows['bucket'].iloc[0]}"
        draws = np.random.Generator(np.random.Philox(xxhash.xxh64_intdigest(key))).random(len(p) + 1)
        i = -1
        for j in np.flatnonzero((p > EDGE) & (p < 1 - EDGE)).tolist():
            if i < 0:
                i = j
                continue
            a, b = size[i], size[j]
            up, down = min((1 - p[i]) * a, p[j] * b), min(p[i] * a, (1 - p[j]) * b)  # words that can move to i, and from i
            words = up if draws[j] * (up + down) < down else -down
            p[i] += words / a
            p[j] -= words / b
            for k in (i, j):
                if p[k] < EDGE or p[k] > 1 - EDGE:
                    p[k] = round(p[k])
            i = next((k for k in (i, j) if 0 < p[k] < 1), -1)
        if final and i >= 0:
            p[i] = float(draws[-1] < p[i])
        p[p < EDGE], p[p > 1 - EDGE] = 0.0, 1.0
        return rows.assign(p=p)

    return pair


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 17, bucket_docs: int = 4096, fan_in: int = 1024) -> DataFrame:
    """Copies of each document so that sources come near their targets.

    Returns doc_id, source, size, source_size, target, copies and taken (``size * copies``). The
    random numbers depend on the seed, the source and the bucket, so reruns agree. A hot source
    is dealt to as many buckets as its documents need; only the leftovers, one in
    ``bucket_docs`` documents, move again.
    """
    sized = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")), "sized")
    targets = materialize(source_targets(sized, weights, most), "targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))  # a null source is one too
    rows = (
        spread_join(sized.withColumn("of", named), targets.withColumn("of", named).drop("source"), "of", F.xxhash64("doc_id", "size"))
        .drop("of")
        .withColumn("whole", F.floor(copies))
        .withColumn("p", F.when(F.col("size") > 0, copies - F.floor(copies)).otherwise(0.0))
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.ceil(F.col("n_docs") / bucket_docs)))
        .drop("n_docs")
    )
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    buckets, level, done = math.ceil(largest / bucket_docs), 0, []
    while True:
        level += 1
        last = buckets <= 1
        rows = rows.groupBy("source", "bucket").applyInPandas(_pivot(seed, level, last), rows.schema)
        if last:
            done.append(rows)
            break
        rows = materialize(rows, f"mix{level}")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(rows.filter(~open_))
        rows = rows.filter(open_).withColumn("bucket", F.floor(F.col("bucket") / fan_in))
        buckets = math.ceil(buckets / fan_in)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    n = (F.col("whole") + F.round("p")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", n.alias("copies"), (F.col("size") * n).alias("taken"))
