"""Point-in-time operators: what was known strictly before a query's minute.

Times are whole minutes (BIGINT); null means it never happened. Each operator is a window over
events and queries sorted together, one shuffle by key, never a range join: an inequality join
would grow with the square of a key's rows.

A key, or the absence of one, may hold all rows. The trailing and pending operators sum events by key and
minute first, and all operators cut keys into slices of time, each a window partition of its own: a
trailing slice has the events that its look-back reaches in the slice before, and a pending slice starts with what was pending
at its start. So the window over all events runs in as many tasks as there are slices, with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Minutes of a slice of the trailing and pending operators, at least as long as their look-back.
SLICE = 1440


def asof_latest(
    queries: DataFrame, events: DataFrame, key: str, query_time: str, event_time: str, tie: str, payload: list[str], *, lookback: int = 1440, slice_minutes: int | None = None, prefix: str = "last_"
) -> DataFrame:
    """The latest event of the query's key in ``[t - lookback, t)``; of events at one minute, the one with the greatest ``tie``.

    Adds ``prefix`` + event_time, tie and payload; nulls where there is none, or key or time is null.
    """
    span = slice_minutes or max(lookback * 7, 1)
    names = [event_time, tie, *payload]
    e = events.filter(F.col(key).isNotNull() & F.col(event_time).isNotNull())
    value = F.struct(*[F.col(n).alias(f"v{i}") for i, n in enumerate(names)])
    first, last = F.floor(F.col(event_time) / span), F.floor((F.col(event_time) + lookback) / span)
    e = e.select(F.col(key).alias("__k"), F.col(event_time).cast("long").alias("__t"), value.alias("__v"), F.explode(F.sequence(first, last)).alias("__slice"), F.lit(None).cast(queries.select(F.struct("*")).schema[0].dataType).alias("__q"))
    known = F.col(key).isNotNull() & F.col(query_time).isNotNull()
    apart = F.when(~known, F.xxhash64(*queries.columns))  # rows that cannot match need not meet
    q = queries.select(F.when(known, F.col(key)).alias("__k"), F.col(query_time).cast("long").alias("__t"), F.lit(None).cast(e.schema["__v"].dataType).alias("__v"), F.coalesce(apart, F.floor(F.col(query_time) / span)).alias("__slice"), F.struct("*").alias("__q"))
    w = Window.partitionBy("__k", "__slice").orderBy("__t").rangeBetween(-lookback, -1)
    out = e.unionByName(q).withColumn("__last", F.max("__v").over(w)).filter("__q IS NOT NULL")
    hit = F.col("__k").isNotNull() & F.col("__t").isNotNull()
    return out.select("__q.*", *[F.when(hit, F.col("__last")[f"v{i}"]).alias(prefix + n) for i, n in enumerate(names)])


def slice_of(t: Column, span: int) -> Column:
    return F.floor(t / span)


def reached_slices(t: Column, width: int, span: int) -> Column:
    """The slices in which an event at ``t`` is seen: its own, and the next one if a look-back of ``width`` reaches it from there."""
    return F.array_distinct(F.array(slice_of(t, span), slice_of(t + width, span)))


def pending_steps(start: Column, end: Column, span: int) -> Column:
    """What an event that is pending after ``start`` up to ``end``, less than a slice later, adds to the sums strictly before a minute: structs of slice, t and d.

    If it goes on in the next slice, it is carried: it enters there the minute before the slice starts, and ends there.
    """
    own, edge = slice_of(start, span), (slice_of(start, span) + 1) * span
    on = end >= edge
    step = lambda at, t, d: F.struct(at.cast("long").alias("slice"), t.cast("long").alias("t"), F.lit(d).alias("d"))
    return F.when(on, F.array(step(own, start, 1), step(own + 1, edge - 1, 1), step(own + 1, end, -1))).otherwise(F.array(step(own, start, 1), step(own, end, -1)))


def _at_minutes(events: DataFrame, key: Column, time: Column, **sums: Column) -> DataFrame:
    return events.select(key.alias("__k"), time.cast("long").alias("__t"), *[c.alias(n) for n, c in sums.items()]).filter("__t IS NOT NULL")


def trailing_stats(queries: DataFrame, events: DataFrame, key: str | None, query_time: str, event_time: str, value: str, *, width: int = 120, name: str = "recent", asks: DataFrame | None = None) -> DataFrame:
    """Count, mean and last time of the key's events in ``[t - width, t)``; without a key, over all events.

    ``asks`` may give the queries' keys and times (default: ``queries``): a chain of these operators
    should take them from the first table, or each step would plan all steps before it twice.

    Events and query times are reduced to one row for each key and minute before the window; its
    answers are joined back by key and minute.
    """
    k, span = F.col(key) if key else F.lit(0), max(SLICE, width)
    e = _at_minutes(events.filter(F.col(value).isNotNull()), k, F.col(event_time), n=F.lit(1), s=F.col(value).cast("double")).withColumn("__slice", F.explode(reached_slices(F.col("__t"), width, span)))
    q = _at_minutes(queries if asks is None else asks, k, F.col(query_time), n=F.lit(0), s=F.lit(0.0)).withColumn("__slice", slice_of(F.col("__t"), span))
    at = e.unionByName(q).groupBy("__k", "__slice", "__t").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.when(F.col("n") > 0, F.col("__t"))).alias("last"))
    w = Window.partitionBy("__k", "__slice").orderBy("__t").rangeBetween(-width, -1)
    at = at.select("__k", "__slice", "__t", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long").alias(f"{name}_count"), F.sum("s").over(w).alias("__s"), F.max("last").over(w).alias(f"{name}_last"))
    at = at.filter(F.col("__slice") == slice_of(F.col("__t"), span)).drop("__slice")
    at = at.withColumn(f"{name}_mean", F.when(F.col(f"{name}_count") > 0, F.col("__s") / F.col(f"{name}_count"))).drop("__s")
    out = queries.join(at, (k == at["__k"]) & (queries[query_time] == at["__t"]), "left").drop("__k", "__t")
    return out.withColumn(f"{name}_count", F.coalesce(f"{name}_count", F.lit(0).cast("long")))


def pending_count(queries: DataFrame, events: DataFrame, key: str, query_time: str, sched: str, actual: str | None, *, width: int = 120, name: str = "pending", asks: DataFrame | None = None) -> DataFrame:
    """Events of the key scheduled in ``[t - width, t)`` that had not happened before t; without ``actual``, all scheduled ones.

    A sweep: +1 when scheduled, -1 when it happens or leaves the window, summed strictly before t, slice by slice.
    """
    s = F.col(sched).cast("long")
    end = F.least(s + width, F.col(actual).cast("long")) if actual else s + width  # least skips null: it never happened
    known = events.filter(F.col(key).isNotNull() & F.col(sched).isNotNull())
    span = max(SLICE, width)
    both = known.select(F.col(key).alias("__k"), F.explode(pending_steps(s, F.greatest(s, end), span)).alias("x")).select("__k", F.col("x.slice").alias("__slice"), F.col("x.t").alias("__t"), F.col("x.d").alias("d"))
    q = (queries if asks is None else asks).filter(F.col(key).isNotNull() & F.col(query_time).isNotNull()).select(F.col(key).alias("__k"), slice_of(F.col(query_time), span).alias("__slice"), F.col(query_time).cast("long").alias("__t"), F.lit(0).alias("d"))
    at = both.unionByName(q).groupBy("__k", "__slice", "__t").agg(F.sum("d").alias("d"))
    # an event scheduled before t counts; its end at t itself has not been seen before t
    w = Window.partitionBy("__k", "__slice").orderBy("__t").rangeBetween(Window.unboundedPreceding, -1)
    at = at.select("__k", "__slice", "__t", F.coalesce(F.sum("d").over(w), F.lit(0)).cast("long").alias(name))
    at = at.filter(F.col("__slice") == slice_of(F.col("__t"), span)).drop("__slice")
    out = queries.join(at, (queries[key] == at["__k"]) & (queries[query_time] == at["__t"]), "left").drop("__k", "__t")
    return out.withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def pending_share(queries: DataFrame, events: DataFrame, key: str, query_time: str, sched: str, actual: str, *, width: int = 120, asks: DataFrame | None = None) -> DataFrame:
    """pending, scheduled and their ratio; null when nothing was scheduled."""
    asks = queries if asks is None else asks
    out = pending_count(queries, events, key, query_time, sched, actual, width=width, asks=asks)
    out = pending_count(out, events, key, query_time, sched, None, width=width, name="scheduled", asks=asks)
    return out.withColumn("pending_share", F.when(F.col("scheduled") > 0, F.col("pending") / F.col("scheduled")))


def hour_lookup(queries: DataFrame, hourly: DataFrame, key: str, query_minute: str, hour_minute: str, values: list[str], tie: str, prefix: str = "at_") -> DataFrame:
    """Values of the key's row at the query's full hour; of several, the first by ``tie``."""
    once = hourly.groupBy(F.col(key).alias("__k"), F.col(hour_minute).alias("__h")).agg(F.min_by(F.struct(*values), F.col(tie)).alias("__v"))
    hour = (F.floor(F.col(query_minute) / 60) * 60).cast("long")
    out = queries.withColumn("__hour", hour).join(once, (F.col(key) == F.col("__k")) & (F.col("__hour") == F.col("__h")), "left")
    return out.select(*queries.columns, *[F.col("__v")[v].alias(prefix + v) for v in values])


def full_hours_sum(hourly: DataFrame, key: str, hour_minute: str, value: str, tie: str, hours: int = 3, name: str = "sum_hours") -> DataFrame:
    """For each key and hour, the sum over the last ``hours`` hours; null unless all of them are there."""
    once = hourly.groupBy(key, hour_minute).agg(F.min_by(value, tie).alias(value))
    w = Window.partitionBy(key).orderBy(hour_minute).rangeBetween(-60 * (hours - 1), 0)
    return once.withColumn(name, F.when(F.count(value).over(w) == hours, F.sum(value).over(w)))


def known_delay(cutoff: str, arrived: str, arr_delay: str, departed: str, dep_delay: str, sched_dep: str, sched_arr: str) -> Column:
    """Delay of the previous leg as known at the cutoff.

    Arrived: its arrival delay. Departed: the larger of its departure delay and how overdue its
    arrival is. Overdue to depart: minutes since its scheduled departure. Else 0.
    """
    c = F.col(cutoff)
    before = lambda t: F.coalesce(F.col(t) < c, F.lit(False))
    return (
        F.when(before(arrived), F.col(arr_delay))
        .when(before(departed), F.greatest(F.col(dep_delay), c - F.col(sched_arr), F.lit(0)))
        .when(before(sched_dep), c - F.col(sched_dep))
        .otherwise(F.lit(0))
    )
