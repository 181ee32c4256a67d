"""Summary tables for dashboards, and the checks that hold them together before they are published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics


def heatmap(flights: DataFrame, row: str, column: str) -> DataFrame:
    """Delay rate of each cell, a ratio of sums over completed rows."""
    done = flights.filter(metrics.completed()).select(row, column, F.col("is_delayed").alias("delayed"), F.lit(1).alias("completed"))
    return metrics.rate_of_sums(done, "delayed", "completed", row, column).select(row, column, F.col("rate").alias("delay_rate"))


def busiest(flights: DataFrame, place: str, n: int) -> DataFrame:
    """The n places with most scheduled rows, with their delay rate; ties by name."""
    by = metrics.metrics_by(flights, place)
    return metrics.top_n(by, n, F.desc("scheduled_flights"), F.asc(place)).select(place, "scheduled_flights", "delay_rate")


def long_form(df: DataFrame, ids: list[str], values: list[str], name: str = "metric") -> DataFrame:
    """Wide metrics to one row for each."""
    wide = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return wide.unpivot(ids, values, name, "value")


def confusion_long(df: DataFrame, label: str, pred: str) -> DataFrame:
    """actual, predicted and count of all four cells, empty ones too."""
    cells = df.sparkSession.range(4).select((F.floor(F.col("id") / 2)).cast("int").alias("actual"), (F.col("id") % 2).cast("int").alias("predicted"))
    counts = df.groupBy(F.col(label).cast("int").alias("a"), F.col(pred).cast("int").alias("p")).agg(F.count("*").alias("n"))
    return cells.join(counts, (cells["actual"] == counts["a"]) & (cells["predicted"] == counts["p"]), "left").select("actual", "predicted", F.coalesce("n", F.lit(0).cast("long")).alias("rows"))


def versions(tables: dict[str, DataFrame], name: str = "version") -> DataFrame:
    """Tables of one shape under each other, each with its name."""
    return reduce(DataFrame.unionByName, [t.withColumn(name, F.lit(v)) for v, t in tables.items()])


def extremes(df: DataFrame, score: str, ties: list[str], top: int = 3, bottom: int = 2) -> DataFrame:
    """The rows of the highest and the lowest scores, marked; two bounded top-k passes."""
    order = [F.asc_nulls_last(t) for t in ties]
    high = df.orderBy(F.desc_nulls_last(score), *order).limit(top).withColumn("kind", F.lit("riskiest"))
    low = df.filter(F.col(score).isNotNull()).orderBy(F.asc(score), *order).limit(bottom).withColumn("kind", F.lit("safest"))
    return high.unionByName(low)


def totals_agree(tables: dict[str, DataFrame], value: str) -> DataFrame:
    """The sum of ``value`` in each table, and whether it is the sum in all of them."""
    sums = reduce(DataFrame.unionByName, [t.agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("total")).select(F.lit(n).alias("table_name"), "total") for n, t in tables.items()])
    ends = sums.agg(F.min("total").alias("lo"), F.max("total").alias("hi"))
    return sums.crossJoin(F.broadcast(ends)).select("table_name", "total", (F.col("lo") == F.col("hi")).alias("agrees"))


def published(by: DataFrame, *keys: str) -> DataFrame:
    """Metrics as they are published: counts, rates in per cent (rounded as decimals, half up), mean delay."""
    pct = lambda c, k: F.round((100 * F.col(c)).cast("decimal(12,4)"), k).cast("double")
    return by.select(*keys, "scheduled_flights", "cancelled_flights", "diverted_flights", "completed_flights", "delayed_flights", pct("on_time_pct", 1).alias("on_time_pct"), pct("delay_rate", 1).alias("delay_rate_pct"), pct("cancellation_rate", 2).alias("cancellation_rate_pct"), "avg_delay")


def chart(df: DataFrame, kind: str, value: str, by: str | None = None) -> DataFrame:
    """A chart's numbers: ``none`` (rows as they are), ``sum`` or ``avg`` by a column, or ``week`` (sums by Sunday-start week of a date)."""
    from ..functions.scalars import week_start

    if kind == "none":
        return df.select(*[c for c in (by, value) if c])
    if kind == "week":
        return df.groupBy(week_start(by).alias(by)).agg(F.sum(value).alias(value))
    return df.groupBy(*([by] if by else [])).agg({"sum": F.sum, "avg": F.avg}[kind](value).alias(value))


def worst_of_busiest(by: DataFrame, place: str, busiest_n: int = 30, worst_n: int = 10) -> DataFrame:
    """Of the places with most scheduled rows, those with the highest delay rate; ties by rank of size, then name."""
    top = metrics.top_n(by, busiest_n, F.desc("scheduled_flights"), F.asc(place))
    return metrics.top_n(top, worst_n, F.desc_nulls_last("delay_rate"), F.desc("scheduled_flights"), F.asc(place)).select(place, "delay_rate")


def comparison(scores: DataFrame, baseline: DataFrame) -> DataFrame:
    """model, metric and value of each model's published metrics, with a random order's beside them."""
    names = {"auc_pr": "AUC-PR", "precision": "Precision", "recall": "Recall"}
    of = lambda df: df.select("model", *[F.col(c).alias(n) for c, n in names.items()]).unpivot("model", list(names.values()), "metric", "value")
    return of(baseline.withColumn("model", F.lit("Random"))).unionByName(of(scores)).select("model", "metric", F.round("value", 4).alias("value"))
