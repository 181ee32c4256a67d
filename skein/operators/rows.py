"""Deduplication, fallback lookups, upserts, partition volumes and rotation: row-level operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. ``order`` must spell where nulls go and be total, or tied rows be equal."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def keep_latest(df: DataFrame, keys: list[str], loaded: str, source: str, *more: Column) -> DataFrame:
    """Latest load wins, then the last source name; nulls are the latest, as a descending order in the source system has them."""
    return keep_first(df, keys, [F.desc_nulls_first(loaded), F.desc_nulls_first(source), *more])


def fallback_lookup(codes: DataFrame, code: str, primary: DataFrame, primary_key: str, fallback: DataFrame, fallback_key: str, prefix: str, columns: list[str]) -> DataFrame:
    """Left lookup by code; codes that miss are looked up by ``prefix || code``. Adds ``columns`` and ``matched_by``.

    The second join's condition holds the first one's miss, so it stays an equi join.
    """
    a = primary.select(F.col(primary_key).alias("__a"), *[F.col(c).alias(f"__a_{c}") for c in columns])
    b = fallback.select(F.col(fallback_key).alias("__b"), *[F.col(c).alias(f"__b_{c}") for c in columns])
    out = codes.join(a, codes[code] == a["__a"], "left")
    out = out.join(b, (b["__b"] == F.concat(F.lit(prefix), out[code])) & out["__a"].isNull(), "left")
    how = F.when(F.col("__a").isNotNull(), "code").when(F.col("__b").isNotNull(), "fallback")
    return out.select(*[F.col(c) for c in codes.columns], *[F.coalesce(f"__a_{c}", f"__b_{c}").alias(c) for c in columns], how.alias("matched_by"))


def named_lookup(df: DataFrame, key: str, dim: DataFrame, dim_key: str, name: str, alias: str) -> DataFrame:
    """Left lookup of a name; a miss gives the key itself."""
    d = dim.select(F.col(dim_key).alias("__k"), F.col(name).alias("__n"))
    return df.join(d, df[key] == d["__k"], "left").withColumn(alias, F.coalesce(F.col("__n"), F.col(key).cast("string"))).drop("__k", "__n")


def code_union(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """Distinct rows of several column lists taken as one table; ``columns``: output name to the inputs in order."""
    names, lists = list(columns), list(columns.values())
    parts = [df.select(*[F.col(lists[j][i]).alias(names[j]) for j in range(len(names))]) for i in range(len(lists[0]))]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def representatives(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row for each key: of each column the least text, in code point order, nulls skipped."""
    return df.groupBy(key).agg(*[F.min(c).alias(c) for c in columns])


def missing_keys(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose non-null key is not known."""
    return df.filter(F.col(key).isNotNull()).join(known.select(F.col(known_key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``existing`` with the same keys; a key that repeats in ``new`` is an error."""
    twice = new.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if twice:
        raise ValueError(f"new rows repeat a key of {keys}")
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*existing.columns))


def volumes(df: DataFrame, **groups: list[str]) -> DataFrame:
    """Adds, for each name, how many rows share the listed columns."""
    out = df
    for name, cols in sorted(groups.items(), key=lambda x: x[1]):  # columns that begin with another list's come after it, in the same exchange
        out = out.withColumn(name, F.count("*").over(Window.partitionBy(*cols)))
    return out.select(*df.columns, *groups)


def rotation(df: DataFrame, vehicle: str, day: str, departs: str, arrives: str, tie: str) -> DataFrame:
    """leg_of_day, legs_today and turnaround of each vehicle's day; nulls where the vehicle is unknown.

    A null vehicle is no group of its own: its rows get nulls. They are dealt out by their tie-break
    column, so that they do not meet in one task.
    """
    known = F.col(vehicle).isNotNull()
    key = F.when(~known, F.col(tie).cast("string"))
    w = Window.partitionBy(vehicle, day, key).orderBy(F.asc_nulls_last(departs), F.asc_nulls_last(tie))
    turn = F.col(departs) - F.lag(arrives).over(w)
    return df.withColumns(
        {
            "leg_of_day": F.when(known, F.row_number().over(w)),
            "legs_today": F.when(known, F.count("*").over(Window.partitionBy(vehicle, day, key))),
            "turnaround": F.when(known & (turn >= 0), turn),
        }
    )
