"""Smoothed rates, lifts and medians by group, and their previous-month history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..steps import discard, materialize, written

#: Rows of a group whose median one task may take; buckets of a larger group's histogram; rows that end its narrowing.
WHOLE, BUCKETS, FEW = 100_000, 1024, 4096


def _null_key(keys: list[str]):
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def group_rates(df: DataFrame, keys: list[str], label: str, weight: float = 50.0) -> DataFrame:
    """rate = (positives + weight * prior) / (rows + weight) and lift = rate / prior for each key; prior is the overall mean.

    Rows with a null key or label do not count for a key. The prior is one row, joined beside every key.
    """
    prior = df.agg(F.avg(F.col(label).cast("double")).alias("prior"))
    by = df.filter(~_null_key(keys) & F.col(label).isNotNull()).groupBy(*keys).agg(F.sum(F.col(label).cast("double")).alias("positives"), F.count("*").alias("rows"))
    rate = (F.col("positives") + weight * F.col("prior")) / (F.col("rows") + weight)
    return by.crossJoin(F.broadcast(prior)).withColumn("rate", rate).withColumn("lift", F.when(F.col("prior") > 0, rate / F.col("prior")))


def smoothed_rate(history: DataFrame, target: DataFrame, keys: list[str], label: str, weight: float = 50.0, name: str = "rate") -> DataFrame:
    """``target`` with the history's smoothed rate and lift; unseen or null keys get the prior and lift 1."""
    prior = history.agg(F.avg(F.col(label).cast("double")).alias("__prior"))
    rates = group_rates(history, keys, label, weight).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("rate").alias("__rate"), F.col("lift").alias("__lift"))
    on = [target[k] == rates[f"__{k}"] for k in keys]
    out = target.join(rates, on, "left").crossJoin(F.broadcast(prior))
    return out.select(*target.columns, F.coalesce("__rate", "__prior").alias(name), F.coalesce("__lift", F.lit(1.0)).alias(f"{name}_lift"))


def medians_by(df: DataFrame, keys: list[str], values: dict[str, str], *, whole: int = WHOLE, buckets: int = BUCKETS, few: int = FEW) -> DataFrame:
    """``keys`` and the exact, interpolated median of each value column (name to column) for every group of known keys; nulls and NaN are skipped.

    Groups of ``whole`` rows at most are taken each by one task. For all larger groups together, histograms (rows by
    group and bucket, summed in tasks) narrow the range in which each middle rank lies, until it holds ``few`` rows or one
    value: no task sees a large group. Their ranges are a table with a row for each rank, of which there are two for each ``whole`` rows at most.
    """
    known = df.filter(~_null_key(keys)).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(v).cast("double").alias(f"__v{i}") for i, v in enumerate(values.values())])
    group = [f"__k{i}" for i in range(len(keys))]
    sizes = known.groupBy(*group).count()
    large = materialize(sizes.filter(F.col("count") > whole).select(*group), "large")
    named = lambda d: d.select(*[F.col(g).alias(k) for g, k in zip(group, keys, strict=True)], *values)
    middle = [F.median(F.when(~F.isnan(f"__v{i}"), F.col(f"__v{i}"))).alias(n) for i, n in enumerate(values)]
    if large.isEmpty():
        return named(known.groupBy(*group).agg(*middle))
    mark = known.join(F.broadcast(large.withColumn("__large", F.lit(True))), group, "left")
    small = mark.filter("__large IS NULL").groupBy(*group).agg(*middle)
    rows = mark.filter("__large").select(*group, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"__v{i}").alias("v")) for i in range(len(values))])).alias("x")).select(*group, "x.i", "x.v").filter("v IS NOT NULL AND NOT isnan(v)")
    rows = materialize(rows, "values")
    at = [*group, "i"]
    half = F.floor(F.col("n") / 2)
    ranks = F.array_distinct(F.array(F.floor((F.col("n") + 1) / 2), half + 1))
    state, place = written(rows.groupBy(*at).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).withColumn("rank", F.explode(ranks)).withColumn("k", F.col("rank")), "ranges")
    settled = (F.col("lo") == F.col("hi")) | (F.col("n") <= few)
    while not state.filter(~settled).isEmpty():
        open_ = state.filter(~settled)
        # overflow of hi - lo gives an infinite width and bucket 0 or NaN; halves avoid it
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1).cast("long"))
        counts = rows.join(F.broadcast(open_.drop("n")), at).filter("v >= lo AND v <= hi").groupBy(*at, "rank", "k", bucket.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        below = F.sum("n").over(Window.partitionBy(*at, "rank").orderBy("b")) - F.col("n")  # over the buckets
        hit = counts.withColumn("below", below).filter("below < k AND k <= below + n").select(*at, "lo", "hi", "n", "rank", (F.col("k") - F.col("below")).alias("k"))
        after, path = written(state.filter(settled).unionByName(hit), "ranges")
        discard(df.sparkSession, place)
        state, place = after, path
    one = state.filter("lo = hi").select(*at, "rank", F.col("lo").alias("v"))
    some = rows.join(F.broadcast(state.filter("lo < hi")), at).filter("v >= lo AND v <= hi")
    some = some.withColumn("r", F.row_number().over(Window.partitionBy(*at, "rank").orderBy("v"))).filter("r = k").select(*at, "rank", "v")  # few rows each
    found = one.unionByName(some).groupBy(*at).agg((F.min("v") / 2 + F.max("v") / 2).alias("v"))
    wide = found.groupBy(*group).agg(*[F.max(F.when(F.col("i") == i, F.col("v"))).alias(n) for i, n in enumerate(values)])
    wide = large.join(wide, group, "left").select(*group, *values)  # a group of nulls has a null
    return named(small.unionByName(wide))


def group_median(history: DataFrame, target: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """``target`` with the exact, interpolated median of the history's group; null for unseen groups and groups of nulls."""
    med = medians_by(history, keys, {"__median": value}).select(*[F.col(k).alias(f"__{k}") for k in keys], "__median")
    return target.join(med, [target[k] == med[f"__{k}"] for k in keys], "left").select(*target.columns, F.col("__median").alias(name))


def previous_month(df: DataFrame, keys: list[str], month: str, label: str, weight: float = 50.0, name: str = "prev") -> DataFrame:
    """Every row with its keys' smoothed rate in the month before; one join on keys and month + 1, no loop.

    The prior is the month before's overall mean. Rows of a month without a month before get null.
    """
    monthly = df.filter(F.col(label).isNotNull()).groupBy((F.col(month) + 1).alias("__m")).agg(F.avg(F.col(label).cast("double")).alias("__prior"))
    by = df.filter(~_null_key(keys) & F.col(label).isNotNull()).groupBy(*[F.col(k).alias(f"__{k}") for k in keys], (F.col(month) + 1).alias("__km")).agg(F.sum(F.col(label).cast("double")).alias("__p"), F.count("*").alias("__n"))
    out = df.join(monthly, df[month] == F.col("__m"), "left").join(by, [df[k] == F.col(f"__{k}") for k in keys] + [df[month] == F.col("__km")], "left")
    rate = (F.coalesce("__p", F.lit(0.0)) + weight * F.col("__prior")) / (F.coalesce("__n", F.lit(0)) + weight)
    return out.withColumn(f"{name}_rate", rate).withColumn(f"{name}_lift", F.when(F.col("__prior") > 0, rate / F.col("__prior"))).select(*df.columns, f"{name}_rate", f"{name}_lift")


#: Rows of a table of rates that may be broadcast.
BROADCAST_RATES = 200_000


def _sums_by_sets(df: DataFrame, sets: list[list[str]], month: str, value: str) -> dict[frozenset, tuple[DataFrame, bool]]:
    """For each set of keys: sums and rows by keys and month, where all keys are known, and whether they are few enough to broadcast.

    One pass with grouping sets makes all of them; they are written once.
    """
    names = list(dict.fromkeys(k for keys in sets for k in keys))
    wanted = list(dict.fromkeys(frozenset(keys) for keys in sets))
    of = {s: sum(1 << (len(names) - i) for i, n in enumerate(names) if n not in s) for s in wanted}  # a bit for each column that is summed over; the month's, the last, never is
    sums = df.groupingSets([[F.col(c) for c in (*[n for n in names if n in s], month)] for s in wanted], *[F.col(c) for c in (*names, month)]).agg(F.grouping_id().alias("__set"), F.sum(value).alias("__p"), F.count("*").alias("__n"))
    lost = F.lit(False)
    for s, i in of.items():
        lost = lost | ((F.col("__set") == i) & _null_key([n for n in names if n in s]))
    sums = materialize(sums.filter(~lost), "rates")
    count = {r["__set"]: r["count"] for r in sums.groupBy("__set").count().collect()}  # a row for each set
    return {s: (sums.filter(F.col("__set") == i), count.get(i, 0) <= BROADCAST_RATES) for s, i in of.items()}


def previous_months(df: DataFrame, target: DataFrame, month: str, label: str, rates: dict[str, list[str]], medians: dict[str, str], median_keys: list[str], *, weight: float = 50.0, relative: bool = True) -> DataFrame:
    """``target`` with what the month before each row's own says of its keys, for all months at once.

    ``rates``: name to keys, smoothed rates (with ``relative``, lifts); an unseen or null key gets the prior
    (lift 1). ``medians``: name to value column, exact medians by ``median_keys``; null for unseen groups.
    All rates come from one pass with grouping sets, and each is one join on keys and month + 1, without a shuffle where the
    table of rates is small. Rows whose month before is missing get nulls.
    """
    known = df.filter(F.col(label).isNotNull())
    y = F.col(label).cast("double")
    out = target.join(F.broadcast(known.groupBy((F.col(month) + 1).alias("__m")).agg(F.avg(y).alias("__prior"))), target[month] == F.col("__m"), "left")  # a row for each month
    sums = _sums_by_sets(known.withColumn("__month", F.col(month) + 1).withColumn("__y", y), list(rates.values()), "__month", "__y") if rates else {}
    for name, keys in rates.items():
        by, small = sums[frozenset(keys)]
        by = by.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__month").alias("__km"), "__p", "__n")
        out = out.join(F.broadcast(by) if small else by, [out[k] == by[f"__{k}"] for k in keys] + [out[month] == by["__km"]], "left")
        rate = (F.coalesce("__p", F.lit(0.0)) + weight * F.col("__prior")) / (F.coalesce("__n", F.lit(0)) + weight)
        out = out.withColumn(name, F.when(F.col("__prior") > 0, rate / F.col("__prior")) if relative else rate).drop(*[f"__{k}" for k in keys], "__km", "__p", "__n")
    if medians:
        mid = medians_by(df, [*median_keys, month], medians).select(*[F.col(k).alias(f"__{k}") for k in median_keys], (F.col(month) + 1).alias("__km"), *medians)
        out = out.join(mid, [out[k] == mid[f"__{k}"] for k in median_keys] + [out[month] == mid["__km"]], "left")
    return out.select(*target.columns, *rates, *medians)
