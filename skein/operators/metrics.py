"""The shared schedule metrics, and aggregates built on them.

Inputs name their columns as in ``FLAGS``: ``is_cancelled`` and ``is_diverted`` (boolean),
``is_delayed`` (0/1 or null) and ``delay`` (minutes or null). Rates are over completed rows,
cancellation over all. Every aggregate is one partial/final hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLAGS = ("is_cancelled", "is_diverted", "is_delayed", "delay")


def completed() -> Column:
    return ~F.col("is_cancelled") & ~F.col("is_diverted")


def status() -> Column:
    """Cancelled before diverted before delayed; a completed row without a label is on time."""
    return (
        F.when(F.col("is_cancelled"), "Cancelled").when(F.col("is_diverted"), "Diverted")
        .when(F.col("is_delayed") == 1, "Delayed 15+ min").otherwise("On time")
    )


def reason(code: Column | str) -> Column:
    """The cancellation code's name; null for others."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c == "A", "Carrier").when(c == "B", "Weather").when(c == "C", "National Air System").when(c == "D", "Security")


def delay_metrics() -> list[Column]:
    """Four counts, the delayed ones, and four averages."""
    done = completed()
    late = F.when(done, F.col("is_delayed"))
    total = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return [
        F.count("*").alias("scheduled_flights"),
        total(F.col("is_cancelled")).alias("cancelled_flights"),
        total(F.col("is_diverted")).alias("diverted_flights"),
        total(done).alias("completed_flights"),
        F.sum(F.when(done, F.col("is_delayed")).otherwise(0)).cast("long").alias("delayed_flights"),
        F.round(F.avg(F.when(F.col("is_cancelled"), 1.0).otherwise(0.0)), 4).alias("cancellation_rate"),
        F.round(F.avg(late.cast("double")), 4).alias("delay_rate"),
        F.round(1 - F.avg(late.cast("double")), 4).alias("on_time_pct"),
        F.round(F.avg(F.when(done, F.col("delay")).cast("double")), 2).alias("avg_delay"),
    ]


def metrics_by(flights: DataFrame, *keys: str | Column) -> DataFrame:
    return flights.groupBy(*keys).agg(*delay_metrics())


def top_routes(flights: DataFrame, route_col: str, least_completed: int, tie: str = "route") -> DataFrame:
    """Routes with enough completed rows, ranked by delay rate, delayed rows and name."""
    by = metrics_by(flights, F.col(route_col).alias(tie)).filter(F.col("completed_flights") >= least_completed)
    order = Window.orderBy(F.desc_nulls_last("delay_rate"), F.desc("delayed_flights"), F.asc(tie))  # over routes, not flights
    return by.withColumn("delay_rank", F.rank().over(order).cast("long"))


def cause_minutes(flights: DataFrame, month: str, causes: dict[str, str]) -> DataFrame:
    """Minutes and rows of each cause and month, over delayed completed rows: wide causes to long, then one aggregate."""
    late = flights.filter(completed() & (F.col("is_delayed") == 1)).select(F.col(month).alias("month"), *[F.col(c).alias(n) for n, c in causes.items()])
    long = late.unpivot("month", list(causes), "cause", "minutes")
    return long.groupBy("month", "cause").agg(F.sum("minutes").cast("long").alias("minutes"), F.count(F.when(F.col("minutes") > 0, 1)).alias("flights"))


def pivot_causes(long: DataFrame, causes: list[str]) -> DataFrame:
    """One column for each cause, in thousands of minutes."""
    wide = long.groupBy("month").pivot("cause", causes).agg(F.sum("minutes"))
    return wide.select("month", *[F.round(F.coalesce(F.col(c), F.lit(0)).cast("double") / 1000, 3).alias(c) for c in causes])


def share_of_total(df: DataFrame, value: str, *group: str) -> DataFrame:
    """Adds the percentage of the group's total."""
    return df.withColumn("share_pct", F.round(F.lit(100.0) * F.col(value) / F.sum(value).over(Window.partitionBy(*group)), 2))


def rate_of_sums(df: DataFrame, over: str, under: str, *group: str, digits: int = 4) -> DataFrame:
    """Sum over sum: a mean of rates would weigh small groups like large ones."""
    return df.groupBy(*group).agg(F.sum(over).cast("long").alias(over), F.sum(under).cast("long").alias(under)).withColumn("rate", F.round(F.col(over).cast("double") / F.col(under), digits))


def weighted_mean(value: str, weight: str) -> Column:
    return F.sum(F.col(value) * F.col(weight)) / F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows of a total order (a bounded top-k on each task, then one merge)."""
    return df.orderBy(*order).limit(n)


def manual_order(c: str, values: list[str]) -> Column:
    """Sort key by a list of values; others come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c))
    return F.when(place > 0, place).otherwise(len(values) + 1)
