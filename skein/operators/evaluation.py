"""Exact evaluation of scores: curves by distinct score, shares, thresholds, calibration, bootstrap.

Rows are first summed by distinct score (and day); the windows then run over distinct scores. The
cumulative sums need one order over all scores: they are found in two levels, sums by range of
scores first, so that no task sees all of them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..steps import materialize


def score_counts(df: DataFrame, score: str, label: str, weight: str | None = None, *group: str) -> DataFrame:
    """(group, s, p, n): weights of the positives and of all rows for each distinct score; null scores or labels are left out."""
    w = F.col(weight) if weight else F.lit(1)
    return df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*group, F.col(score).alias("s")).agg(F.sum(F.when(F.col(label) == 1, w).otherwise(0)).cast("double").alias("p"), F.sum(w).cast("double").alias("n"))


def cumulated(counts: DataFrame, *group: str, width: float | None = None, tables: int = 4096) -> DataFrame:
    """Adds tp and c: positives and rows at this score or above, by two levels of windows.

    Scores fall into ``tables`` equal ranges between the least and the greatest; the first level sums
    within a range, the second over the ranges' totals, of which there are ``tables`` at most.
    """
    ends = counts.agg(F.min("s").alias("__lo"), F.max("s").alias("__hi"))
    part = F.when(F.col("__hi") > F.col("__lo"), F.least(F.floor((F.col("s") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * tables), F.lit(tables - 1))).otherwise(0)
    c = counts.crossJoin(F.broadcast(ends)).withColumn("__part", part.cast("long")).drop("__lo", "__hi")
    totals = c.groupBy(*group, "__part").agg(F.sum("p").alias("__p"), F.sum("n").alias("__n"))
    above = Window.partitionBy(*group).orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__part").alias("__at"), F.coalesce(F.sum("__p").over(above), F.lit(0.0)).alias("__p"), F.coalesce(F.sum("__n").over(above), F.lit(0.0)).alias("__n"))
    within = Window.partitionBy(*group, "__part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("__tp", F.sum("p").over(within)).withColumn("__c", F.sum("n").over(within))
    on = [c["__part"] == totals["__at"]] + [c[g].eqNullSafe(totals[f"__g{i}"]) for i, g in enumerate(group)]
    return c.join(totals, on).select(*counts.columns, (F.col("__tp") + F.col("__p")).alias("tp"), (F.col("__c") + F.col("__n")).alias("c"))


def curve_metrics(df: DataFrame, score: str, label: str, weight: str | None = None, *group: str) -> DataFrame:
    """rows, positives, roc_auc and average_precision; ties count half, and null if there is one class only.

    average precision = sum(p / P * tp / c); ROC AUC = sum((n - p) * (tp - p / 2)) / (P * N).
    """
    at = cumulated(score_counts(df, score, label, weight, *group), *group)
    out = at.groupBy(*group).agg(F.sum("n").alias("rows"), F.sum("p").alias("positives"), F.sum(F.col("p") * F.col("tp") / F.col("c")).alias("a"), F.sum((F.col("n") - F.col("p")) * (F.col("tp") - F.col("p") / 2)).alias("b"))
    P, N = F.col("positives"), F.col("rows") - F.col("positives")
    return out.select(*group, "rows", "positives", F.when((P > 0) & (N > 0), F.col("b") / (P * N)).alias("roc_auc"), F.when(P > 0, F.col("a") / P).alias("average_precision"))


#: Rows whose keys may be looked at on the driver to settle the last ties.
FEW = 4096


def _plain(v):
    """Bytes that can stand in a set."""
    return bytes(v) if isinstance(v, bytearray) else v


def _place(v) -> tuple:
    """What a value sorts by as Spark's ascending order, nulls last: NaN after all numbers."""
    return (v is None, False, 0) if v is None else (False, v != v, 0 if v != v else v)


def _narrowed(counts: DataFrame, wanted: list[tuple[int, int]], before: list[tuple]) -> list[tuple[tuple, int]]:
    """The value at each wanted rank among the ``counts`` (of, value, n) of its ``of``, put behind the values before it, and the rank among the rows with it.

    Values are dealt in ranges of their own order, of whatever type; the ranges' sums tell in which one a rank
    falls, and running sums within those ranges alone find the value. No task sees all values.
    """
    spark = counts.sparkSession
    order = [F.asc("of"), F.asc_nulls_last("value")]
    ranged = materialize(counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("part", F.spark_partition_id()), "ranges")
    upto: dict[int, list] = {}
    for r in ranged.groupBy("of", "part").agg(F.sum("n").alias("n")).orderBy("of", "part").collect():  # a row for each range, and one more for each ``of``
        own = upto.setdefault(r["of"], [])
        own.append((r["part"], own[-1][2] if own else 0.0, (own[-1][2] if own else 0.0) + r["n"]))
    at = [next(x for x in upto[of] if x[1] < k <= x[2]) for of, k in wanted]
    listed = spark.createDataFrame([(of, x[0], float(k - x[1]), i) for i, ((of, k), x) in enumerate(zip(wanted, at, strict=True))], "of int, part int, k double, i int")
    inside = ranged.join(F.broadcast(listed.select("of", "part").distinct()), ["of", "part"]).withColumn("upto", F.sum("n").over(Window.partitionBy("of", "part").orderBy(F.asc_nulls_last("value"))))
    hit = {r["i"]: r for r in inside.join(F.broadcast(listed), ["of", "part"]).filter("upto - n < k AND k <= upto").select("i", "value", (F.col("upto") - F.col("n")).alias("before")).collect()}
    return [(p + (_plain(hit[i]["value"]),), int(k - at[i][1] - hit[i]["before"])) for i, (p, (_, k)) in enumerate(zip(before, wanted, strict=True))]


def keys_at(df: DataFrame, order: list[str], ranks: list[int]) -> list[tuple]:
    """The keys at the given ranks (from 1) of all rows by the ascending ``order`` columns, nulls last.

    A selection, not a sort: for one column after the other, rows are counted by value among those
    that still tie with a sought key, and the value at which a rank falls is kept; at most one row for
    each rank reaches the driver. The last ties, of ``FEW`` rows at most, are settled there. Values are
    compared as they are: integers and decimals of any size, text and bytes are exact.
    """
    spark, kinds = df.sparkSession, dict(df.dtypes)
    state = [((), r) for r in ranks]  # each rank's values so far, and its rank among the rows that share them
    for j, c in enumerate(order):
        asked = sorted({p for p, _ in state}, key=str)
        if j == 0:
            rows = df.select(F.lit(0).alias("of"), F.col(c).alias("value"))
        else:
            listed = spark.createDataFrame([(i, *p) for i, p in enumerate(asked)], "of int, " + ", ".join(f"__{x} {kinds[x]}" for x in order[:j]))
            rows = df.join(F.broadcast(listed), [df[x].eqNullSafe(listed[f"__{x}"]) for x in order[:j]])
            few = rows.select("of", *order[j:]).limit(FEW + 1).collect()
            if len(few) <= FEW:
                return [p + sorted([tuple(map(_plain, r))[1:] for r in few if r["of"] == asked.index(p)], key=lambda v: tuple(map(_place, v)))[k - 1] for p, k in state]
            rows = rows.select("of", F.col(c).alias("value"))
        counts = rows.groupBy("of", "value").agg(F.count("*").cast("double").alias("n"))
        some = counts.limit(FEW + 1).collect()
        if len(some) <= FEW:  # few values: their running sums need no window
            at: dict[int, list] = {}
            for r in sorted(some, key=lambda r: (r["of"], _place(r["value"]))):
                own = at.setdefault(r["of"], [])
                own.append((_plain(r["value"]), own[-1][2] if own else 0.0, (own[-1][2] if own else 0.0) + r["n"]))
            hits = [next(x for x in at[asked.index(p)] if x[1] < k <= x[2]) for p, k in state]
            state = [(p + (x[0],), k - int(x[1])) for (p, k), x in zip(state, hits, strict=True)]
            continue
        state = _narrowed(counts, [(asked.index(p), k) for p, k in state], [p for p, _ in state])
    return [p for p, _ in state]


def after(order: list[str], key: tuple) -> Column:
    """Whether a row comes after ``key``, nulls last."""
    out = F.lit(False)
    for c, v in reversed(list(zip(order, key, strict=True))):
        x = F.col(c)
        out = (F.lit(False) if v is None else x.isNull() | (x > F.lit(v))) | (x.eqNullSafe(F.lit(v)) & out)
    return F.coalesce(out, F.lit(False))


def top_share(df: DataFrame, score: str, share: float, ties: list[str], name: str = "flagged") -> DataFrame:
    """Flags the first round(share * rows) rows by score, ties by the listed columns; null scores come last.

    Rows that are equal in all of these columns are flagged together or not at all. The table is
    written once; the cut is found by ``keys_at``, without an order over all rows.
    """
    rows = materialize(df, "scores")
    n = rows.count()
    k = int(round(share * n))
    if k == 0 or n == 0:
        return rows.withColumn(name, F.lit(0))
    order = ["__down", *ties]
    down = rows.withColumn("__down", -F.col(score))
    [cut] = keys_at(down.select(*order), order, [k])
    return down.withColumn(name, (~after(order, cut)).cast("int")).drop("__down")


def confusion(label: str, pred: str) -> list[Column]:
    """tn, fp, fn, tp and the ratios made of them, rounded to 4 places."""
    count = lambda y, p: F.count(F.when((F.col(label) == y) & (F.col(pred) == p), 1))
    tn, fp, fn, tp = count(0, 0), count(0, 1), count(1, 0), count(1, 1)
    over = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 4)
    return [
        tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"), over(tp.cast("double"), tp + fp).alias("precision"), over(tp.cast("double"), tp + fn).alias("recall"),
        over(2.0 * tp, 2 * tp + fp + fn).alias("f1_score"), over((tp + tn).cast("double"), tn + fp + fn + tp).alias("accuracy"), over((tp + fp).cast("double"), tn + fp + fn + tp).alias("predicted_positive_rate"),
    ]


def threshold_sweep(df: DataFrame, label: str, known: str, thresholds: list[int]) -> DataFrame:
    """Confusion of "flag if known >= x" for each x (above 0 for x = 0).

    Rows are counted once by the largest threshold that they reach; each threshold sums those.
    """
    ordered = sorted(thresholds)
    reach = F.when(F.col(known).isNull(), -1).otherwise(F.size(F.filter(F.array(*[F.lit(x) for x in ordered]), lambda x: F.when(x > 0, F.col(known) >= x).otherwise(F.col(known) > 0))))
    counts = df.filter(F.col(label).isNotNull()).groupBy(reach.alias("reach")).agg(F.sum((F.col(label) == 1).cast("long")).alias("p"), F.count("*").alias("n"))
    at = counts.select("reach", "p", "n", F.posexplode(F.array(*[F.lit(x) for x in ordered])).alias("i", "threshold"))
    hit = F.col("reach") > F.col("i")
    s = lambda cond, v: F.coalesce(F.sum(F.when(cond, v)), F.lit(0)).cast("long")
    neg = F.col("n") - F.col("p")
    out = at.groupBy("threshold").agg(s(~hit, neg).alias("tn"), s(hit, neg).alias("fp"), s(~hit, F.col("p")).alias("fn"), s(hit, F.col("p")).alias("tp"))
    ratio = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 4)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.withColumns({"precision": ratio(tp.cast("double"), tp + fp), "recall": ratio(tp.cast("double"), tp + fn), "f1_score": ratio(2.0 * tp, 2 * tp + fp + fn)})


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold of the best rounded F1; ties take the smaller."""
    return sweep.orderBy(F.desc("f1_score"), F.asc("threshold")).limit(1)


def rank_bin(rank: Column, total: Column, bins: int = 10) -> Column:
    """Bin 1..bins of a rank from 1, cut like quantiles of the ranks (not like ``ntile``)."""
    return F.when(total > 1, F.greatest(F.ceil((rank - 1) * bins / (total - 1)), F.lit(1))).otherwise(1).cast("int")


def calibration(df: DataFrame, score: str, label: str, ties: list[str], bins: int = 10) -> DataFrame:
    """decile, rows, mean score and actual rate, by rank bins; rows without a score are left out.

    Only the last row of each bin is sought (``keys_at``); a row's bin is how many of these it comes after.
    """
    rows = materialize(df.filter(F.col(score).isNotNull()).select(score, label, *[c for c in ties if c not in (score, label)]), "scores")
    n, order = rows.count(), [score, *ties]
    # the last rank r of bin i: (r - 1) * bins / (n - 1) <= i
    ends = sorted({1 + i * (n - 1) // bins for i in range(1, bins)}) if n > 1 else []
    at = [(i, 1 + i * (n - 1) // bins) for i in range(1, bins)] if n > 1 else []
    keys = dict(zip(ends, keys_at(rows.select(*order), order, ends), strict=True)) if ends else {}
    decile = sum((after(order, keys[r]).cast("int") for _, r in at), F.lit(1))
    out = rows.withColumn("decile", decile)
    return out.groupBy("decile").agg(F.count("*").alias("rows"), F.round(F.avg(score), 4).alias("mean_predicted"), F.round(F.avg(F.col(label).cast("double")), 4).alias("actual_rate"))


def brier(df: DataFrame, score: str, label: str, *group: str) -> DataFrame:
    """Mean squared error of the scores, and of the constant base rate (p (1 - p))."""
    d = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    y = F.col(label).cast("double")
    return d.groupBy(*group).agg(F.count("*").alias("rows"), F.avg((F.col(score) - y) * (F.col(score) - y)).alias("brier"), (F.avg(y) * (1 - F.avg(y))).alias("brier_constant"))


def random_baseline(df: DataFrame, label: str, share: float) -> DataFrame:
    """What a random order gets: the base rate, and the flagged share as recall."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("base_rate")).select(F.round("base_rate", 4).alias("average_precision"), F.round("base_rate", 4).alias("precision"), F.lit(share).alias("recall"))


#: Ranges of scores, each of which one task cumulates for all resamples; rows that it takes at a time.
RANGES, SLAB = 256, 20_000


def day_draws(days: list, reps: int, seed: int) -> np.ndarray:
    """How often each resample (a column) draws each day (a row)."""
    rng = np.random.RandomState(seed)
    return np.stack([np.bincount(rng.randint(0, len(days), len(days)), minlength=len(days)) for _ in range(reps)], axis=1) if days else np.zeros((0, reps), np.int64)


def resampled(df: DataFrame, day: str, label: str, scores: dict[str, str], draws: dict, *, ranges: int = RANGES) -> DataFrame:
    """which, rep, rows, positives, roc_auc and average_precision of each score (name to column) in each resample.

    ``draws``: day to the weights of its rows, an integer for each resample; a day that it lacks counts for none. Rows are summed
    by score and day once, and never multiplied: a row takes its day's weights as an array, and all resamples' running sums go
    element by element over arrays. Scores are dealt in ranges of about equally many; what stands above a range comes from
    sums by range and day, so ranges run in as many tasks. Rows with a null or NaN score, or without a label or day, are left out; null areas if a
    resample holds one class only. The weights (days by resamples) go with the tasks.
    """
    from collections.abc import Iterator

    import pyarrow as pa

    spark, names = df.sparkSession, list(scores)
    order = {d: i for i, d in enumerate(draws)}
    reps = len(next(iter(draws.values()))) if draws else 0
    weights = np.array(list(draws.values()), np.float64).reshape(len(draws), reps)
    known = spark.createDataFrame(list(order.items()), f"__day {df.schema[day].dataType.simpleString()}, at int")
    made = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).cast("double").alias("s")) for i, c in enumerate(scores.values())])
    long = df.filter(F.col(label).isNotNull()).select(F.col(day).alias("__day"), (F.col(label) == 1).cast("long").alias("y"), F.explode(made).alias("x")).select("__day", "y", "x.which", "x.s").filter("s IS NOT NULL AND NOT isnan(s)")
    counts = long.join(F.broadcast(known), "__day").groupBy("which", "s", "at").agg(F.sum("y").alias("p"), F.count("*").alias("n"))
    counts = materialize(counts.withColumn("s", F.col("s") + 0.0), "counts")  # one zero
    shares = [k / ranges for k in range(1, ranges)]
    cuts = {r["which"]: np.unique(r["q"]) for r in counts.groupBy("which").agg(F.percentile_approx("s", shares, 100 * ranges).alias("q")).collect()} if shares else {}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            which, s = (b.column(c).to_numpy() for c in ("which", "s"))
            part = np.zeros(len(s), np.int32)
            for w, q in cuts.items():
                part[which == w] = np.searchsorted(q, s[which == w], side="left")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part)], [*b.schema.names, "part"])

    dealt = counts.mapInArrow(deal, "which int, s double, at int, p long, n long, part int")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, p, n in _grouped(batches, False):
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([p.sum(axis=0)], pa.list_(pa.float64())), pa.array([n.sum(axis=0)], pa.list_(pa.float64()))], ["which", "part", "p", "n"])

    def _grouped(batches: Iterator[pa.RecordBatch], by_score: bool) -> Iterator[tuple]:
        """(which, part), and weighted positives and rows of its distinct scores (or of the range), highest first, a slab at a time; rows come in that order."""
        held = None
        for b in batches:
            for low in range(0, b.num_rows, SLAB):
                part = b.slice(low, SLAB)
                which, of, s, at, p, n = (part.column(c).to_numpy() for c in ("which", "part", "s", "at", "p", "n"))
                first = np.ones(len(s), bool)
                first[1:] = (which[1:] != which[:-1]) | (of[1:] != of[:-1]) | ((s[1:] != s[:-1]) if by_score else False)
                start = np.flatnonzero(first)
                w = weights[at]
                ps, ns = np.add.reduceat(w * p[:, None], start, axis=0), np.add.reduceat(w * n[:, None], start, axis=0)
                keys = list(zip(which[start].tolist(), of[start].tolist(), s[start].tolist() if by_score else [0.0] * len(start), strict=True))
                if held and held[0] == keys[0]:  # goes on from the slab before
                    ps[0] += held[1]
                    ns[0] += held[2]
                elif held:
                    yield held[0][:2], held[1][None], held[2][None]
                ends = [0, *[i for i in range(1, len(keys) - 1) if keys[i][:2] != keys[i - 1][:2]], len(keys) - 1]
                for i, j in zip(ends[:-1], ends[1:], strict=True):
                    if j > i:
                        yield keys[i][:2], ps[i:j], ns[i:j]
                held = (keys[-1], ps[-1], ns[-1])
        if held:
            yield held[0][:2], held[1][None], held[2][None]

    sums = dealt.groupBy("which", "part", "at").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).withColumn("s", F.lit(0.0)).select("which", "s", "at", "p", "n", "part").repartition("which", "part").sortWithinPartitions("which", "part")
    above: dict[tuple, tuple] = {}
    whole = {i: (np.zeros(reps), np.zeros(reps)) for i in range(len(names))}
    for r in sorted(sums.mapInArrow(total, "which int, part int, p array<double>, n array<double>").collect(), key=lambda r: (r["which"], -r["part"])):  # a row for each range
        above[r["which"], r["part"]] = whole[r["which"]]
        whole[r["which"]] = tuple(x + np.array(r[c]) for x, c in zip(whole[r["which"]], ("p", "n"), strict=True))

    def cumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tp, c, ap, auc = None, None, None, None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([ap], pa.list_(pa.float64())), pa.array([auc], pa.list_(pa.float64()))], ["which", "ap", "auc"])
        for k, p, n in _grouped(batches, True):
            if k != key:
                if key is not None:
                    yield row()
                key, (tp, c), ap, auc = k, above[k], np.zeros(reps), np.zeros(reps)
            tps, cs = tp + np.cumsum(p, axis=0), c + np.cumsum(n, axis=0)
            ap = ap + (p * tps / np.where(cs > 0, cs, 1)).sum(axis=0)
            auc = auc + ((n - p) * (tps - p / 2)).sum(axis=0)
            tp, c = tps[-1], cs[-1]
        if key is not None:
            yield row()

    out = {i: (np.zeros(reps), np.zeros(reps)) for i in range(len(names))}
    ordered = dealt.repartition("which", "part").sortWithinPartitions("which", "part", F.desc("s"))
    for r in sorted(ordered.mapInArrow(cumulate, "which int, ap array<double>, auc array<double>").collect(), key=lambda r: (r["which"], r["ap"])):  # a row for each range
        out[r["which"]] = (out[r["which"]][0] + np.array(r["ap"]), out[r["which"]][1] + np.array(r["auc"]))
    rows = []
    for i, name in enumerate(names):
        (p, n), (ap, auc) = whole[i], out[i]
        rows += [(name, k, float(n[k]), float(p[k]), float(auc[k] / (p[k] * (n[k] - p[k]))) if 0 < p[k] < n[k] else None, float(ap[k] / p[k]) if p[k] > 0 else None) for k in range(reps)]
    return spark.createDataFrame(rows, "which string, rep int, rows double, positives double, roc_auc double, average_precision double")


def day_bootstrap(df: DataFrame, day: str, label: str, score_a: str, score_b: str, *, reps: int = 200, seed: int = 42) -> DataFrame:
    """Differences a - b of ROC AUC and average precision for each resample of days; the driver draws days, never rows."""
    days = [r[0] for r in df.select(day).filter(F.col(day).isNotNull()).distinct().orderBy(day).collect()]
    found = resampled(df, day, label, {"a": score_a, "b": score_b}, dict(zip(days, day_draws(days, reps, seed).tolist(), strict=True)))
    at = lambda m, k: F.max(F.when(F.col("which") == k, F.col(m)))
    return found.groupBy("rep").agg((at("roc_auc", "a") - at("roc_auc", "b")).alias("auc_roc_diff"), (at("average_precision", "a") - at("average_precision", "b")).alias("auc_pr_diff"))


def interval(diffs: DataFrame) -> DataFrame:
    """95 % percentile intervals of the resampled differences, with linear interpolation."""
    p = lambda c, q: F.percentile(c, q)
    return diffs.agg(*[p(c, q).alias(f"{c}_{n}") for c in ("auc_roc_diff", "auc_pr_diff") for n, q in (("low", 0.025), ("high", 0.975))], F.count("*").alias("reps"))


def compared(df: DataFrame, day: str, label: str, score_a: str, score_b: str, *, reps: int = 200, seed: int = 42) -> DataFrame:
    """The differences a - b on all rows beside their 95 % intervals over resampled days; rounded to 4 places."""
    metric = lambda s: curve_metrics(df, s, label)
    a, b = (metric(s).select(*[F.col(c).alias(f"{c}_{k}") for c in ("roc_auc", "average_precision")]) for k, s in (("a", score_a), ("b", score_b)))
    whole = a.crossJoin(b).select((F.col("roc_auc_a") - F.col("roc_auc_b")).alias("auc_roc_diff"), (F.col("average_precision_a") - F.col("average_precision_b")).alias("auc_pr_diff"))  # one row each
    out = whole.crossJoin(interval(day_bootstrap(df, day, label, score_a, score_b, reps=reps, seed=seed)))
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns if c != "reps"], "reps")


def shares(df: DataFrame, score: str, label: str, ties: list[str], at: tuple[float, ...] = (0.2, 0.1)) -> DataFrame:
    """One row for each share: the confusion of its flags, and the two areas of the score."""
    area = curve_metrics(df, score, label).select(F.round("roc_auc", 4).alias("auc_roc"), F.round("average_precision", 4).alias("auc_pr"))
    parts = [top_share(df, score, x, ties).agg(*confusion(label, "flagged")).select(F.lit(x).alias("share"), "*") for x in at]
    return reduce(DataFrame.unionByName, parts).crossJoin(F.broadcast(area))  # one row beside two


def robustness(df: DataFrame, score: list[str], label: str, turn: str, least: int = 20) -> DataFrame:
    """Each score's areas without the rows whose scheduled turn is shorter than ``least`` (the mark of a swapped vehicle); an unknown turn stays.

    The excluded and kept rows and their delay rates stand beside every score.
    """
    swapped = F.coalesce(F.col(turn) < least, F.lit(False))
    y = F.col(label).cast("double")
    counts = df.agg(
        F.count(F.when(swapped, 1)).alias("excluded"), F.round(F.avg(F.when(swapped, y)), 4).alias("excluded_rate"), F.count(F.when(~swapped, 1)).alias("kept"), F.round(F.avg(F.when(~swapped, y)), 4).alias("kept_rate"),
    )
    kept = df.filter(~swapped)
    parts = [curve_metrics(kept, s, label).select(F.lit(s).alias("model"), F.round("roc_auc", 4).alias("auc_roc"), F.round("average_precision", 4).alias("auc_pr")) for s in score]
    return reduce(DataFrame.unionByName, parts).crossJoin(F.broadcast(counts))  # one row beside each


def platt(df: DataFrame, score: str, label: str) -> dict[str, float]:
    """Slope and intercept of the label on the score's logit; slope 1 and intercept 0 are well calibrated."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from ..functions.scalars import logit

    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(logit(score).alias("z"), F.col(label).cast("double").alias("y"))
    fitted = LogisticRegression(featuresCol="f", labelCol="y", regParam=0.0, maxIter=200, tol=1e-10).fit(VectorAssembler(inputCols=["z"], outputCol="f").transform(rows))
    return {"slope": float(fitted.coefficients[0]), "intercept": float(fitted.intercept)}
