"""Point-in-time features of scheduled events: what was known ``lead`` minutes before departure.

The event table has one row for each scheduled leg, cancelled ones too (they are scheduled, and
pending, like others): key, vehicle, carrier, origin, dest, and whole minutes sched_dep,
sched_arr, actual_dep, actual_arr with dep_delay and arr_delay (null: never happened). Every value
comes with the time, and where it is one leg's the key, of the event that it was taken from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip
from .temporal import SLICE, asof_latest, full_hours_sum, hour_lookup, known_delay, pending_steps, reached_slices, slice_of

#: Minutes before departure, window and look-back; bounds of a delay in averages; the weather's columns.
LEAD, WIDTH, LOOKBACK, CLIP = 120, 120, 1440, (-30, 300)
WEATHER = ["temperature_c", "precipitation_mm", "snowfall_cm", "wind_speed_kmh", "wind_gusts_kmh", "cloud_cover_low_pct"]


def with_cutoff(legs: DataFrame, lead: int = LEAD) -> DataFrame:
    return legs.withColumn("cutoff", F.col("sched_dep") - lead)


def inbound(legs: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Previous scheduled leg of the vehicle, what was known of it, and the latest departed and arrived legs."""
    own = ["sched_dep", "sched_arr", "actual_dep", "actual_arr", "dep_delay", "arr_delay"]
    events = legs.select("vehicle", "key", *own)
    # two operators on one key: the time is aliased so that payload and time may be the same column
    out = asof_latest(legs, events.withColumn("at", F.col("sched_dep")), "vehicle", "sched_dep", "at", "key", own, lookback=lookback, prefix="prev_")
    c, has = F.col("cutoff"), F.col("prev_key").isNotNull()
    before = lambda t: F.coalesce(F.col(t) < c, F.lit(False))
    departed, arrived, due = before("prev_actual_dep"), before("prev_actual_arr"), before("prev_sched_dep")
    known = known_delay("cutoff", "prev_actual_arr", "prev_arr_delay", "prev_actual_dep", "prev_dep_delay", "prev_sched_dep", "prev_sched_arr")
    known = F.when(has, known).otherwise(0)
    turn = F.col("sched_dep") - F.col("prev_sched_arr")
    out = out.withColumns(
        {
            "inb_has_prev": has.cast("int"), "inb_sched_turn_min": turn, "inb_prev_sched_dep_before_cutoff": due.cast("int"), "inb_prev_departed": departed.cast("int"),
            "inb_prev_dep_delay": F.when(departed, F.col("prev_dep_delay")), "inb_prev_arrived": arrived.cast("int"), "inb_prev_arr_delay": F.when(arrived, F.col("prev_arr_delay")),
            "inb_prev_overdue_min": F.when(due & ~departed, c - F.col("prev_sched_dep")).otherwise(0), "inb_known_delay_min": known,
            "inb_projected_slack_min": F.when(has, turn - F.greatest(known, F.lit(0))), "inb_prev_dep_ts": F.when(departed, F.col("prev_actual_dep")), "inb_prev_arr_ts": F.when(arrived, F.col("prev_actual_arr")),
        }
    ).withColumnRenamed("prev_key", "prev_leg_key").drop(*[f"prev_{x}" for x in ["at", *own]])
    for kind in ("dep", "arr"):
        e = events.filter(F.col(f"actual_{kind}").isNotNull()).select("vehicle", "key", F.col(f"actual_{kind}").alias("ts"), F.col(f"{kind}_delay").alias("delay"))
        out = asof_latest(out, e, "vehicle", "cutoff", "ts", "key", ["delay"], lookback=lookback, prefix=f"ac_latest_{kind}_")
    return out


def _recent(asks: DataFrame, events: DataFrame, ends: DataFrame | None, kinds: list[str], width: int, name: str) -> DataFrame:
    """One row for each key and minute of ``asks`` (k, t): of each kind of event, what lay in ``[t - width, t)``.

    ``events`` has k, t, kind and v; ``ends`` has k, slice, t and d, the steps of what is pending. Both are
    reduced to one row for each key and minute of a slice first, so that one shuffle and one order serve all windows.
    """
    span = max(SLICE, width)
    blank = {"kind": F.lit(None).cast("string"), "v": F.lit(None).cast("double"), "d": F.lit(0)}
    rows = events.select("k", F.explode(reached_slices(F.col("t"), width, span)).alias("slice"), "t", "kind", "v", F.lit(0).alias("d"))
    rows = rows.unionByName(asks.distinct().select("k", slice_of(F.col("t"), span).alias("slice"), "t", *[c.alias(n) for n, c in blank.items()]).withColumn("ask", F.lit(1)), allowMissingColumns=True)
    if ends is not None:
        rows = rows.unionByName(ends.select("k", "slice", "t", blank["kind"].alias("kind"), blank["v"].alias("v"), "d"), allowMissingColumns=True)
    of = lambda kind: F.col("kind") == kind
    sums = [F.max("ask").alias("ask"), F.sum("d").alias("d")]
    for kind in kinds:
        sums += [F.count(F.when(of(kind), 1)).alias(f"{kind}_n"), F.sum(F.when(of(kind), F.col("v"))).alias(f"{kind}_s"), F.max(F.when(of(kind), F.col("t"))).alias(f"{kind}_l")]
    at = rows.filter("k IS NOT NULL AND t IS NOT NULL").groupBy("k", "slice", "t").agg(*sums)
    w = Window.partitionBy("k", "slice").orderBy("t")
    near, before = w.rangeBetween(-width, -1), w.rangeBetween(Window.unboundedPreceding, -1)
    out = [F.coalesce(F.sum("d").over(before), F.lit(0)).cast("long").alias(f"{name}_pending")]
    for kind in kinds:
        n = F.coalesce(F.sum(f"{kind}_n").over(near), F.lit(0)).cast("long")
        out += [n.alias(f"{name}_{kind}_count"), F.when(n > 0, F.sum(f"{kind}_s").over(near) / n).alias(f"{name}_{kind}_mean"), F.max(f"{kind}_l").over(near).alias(f"{name}_{kind}_last")]
    return at.select("k", "t", "ask", *out).filter("ask = 1").drop("ask")


def congestion(out: DataFrame, legs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``out`` (rows of ``legs``) with recent departures and arrivals at both ends, of the carrier and overall, and pending departures.

    One table of places answers for both ends, one of carriers and one of all events for the rest: three
    windows over sums by key and minute and four joins, whatever the number of features.
    """
    happened = lambda place, kind: legs.filter(F.col(f"{kind}_delay").isNotNull()).select(place.alias("k"), F.col(f"actual_{kind}").cast("long").alias("t"), F.lit(kind).alias("kind"), clip(f"{kind}_delay", *CLIP).cast("double").alias("v"))
    sched = F.col("sched_dep").cast("long")
    due = legs.select(F.col("origin").alias("k"), sched.alias("t"), F.lit("sched").alias("kind"), F.lit(None).cast("double").alias("v"))
    leaves = F.greatest(sched, F.least(sched + width, F.col("actual_dep").cast("long")))  # least skips null: it never left
    ends = legs.filter("sched_dep IS NOT NULL").select(F.col("origin").alias("k"), F.explode(pending_steps(sched, leaves, max(SLICE, width))).alias("x")).select("k", "x.slice", "x.t", "x.d")
    ask = lambda place: legs.select(place.alias("k"), F.col("cutoff").cast("long").alias("t"))
    place, one = F.col("origin"), F.lit(0)
    places = _recent(ask(place).unionByName(ask(F.col("dest"))), happened(place, "dep").unionByName(happened(F.col("dest"), "arr")).unionByName(due), ends, ["dep", "arr", "sched"], width, "at")
    carriers = _recent(ask(F.col("carrier")), happened(F.col("carrier"), "dep"), None, ["dep"], width, "at")
    every = _recent(ask(one), happened(one, "dep"), None, ["dep"], width, "at")

    def answered(rows: DataFrame, answers: DataFrame, key: Column, names: dict[str, str]) -> DataFrame:
        found = answers.select(F.col("k").alias("__k"), F.col("t").alias("__t"), *[F.col(f"at_{a}").alias(b) for a, b in names.items()])
        return rows.join(found, (key == found["__k"]) & (rows["cutoff"] == found["__t"]), "left").drop("__k", "__t")

    stats = lambda kind, name: {f"{kind}_{x}": f"{name}_{x}" for x in ("count", "mean", "last")}
    counts = ["origin_recent_dep", "origin_recent_arr", "dest_recent_arr", "dest_recent_dep", "carrier_recent_dep", "all_recent_dep"]
    out = answered(out, places, out["origin"], stats("dep", counts[0]) | stats("arr", counts[1]) | {"pending": "origin_pending_count", "sched_count": "__sched"})
    out = answered(out, places, out["dest"], stats("arr", counts[2]) | stats("dep", counts[3]))
    out = answered(out, carriers, out["carrier"], stats("dep", counts[4]))
    out = answered(out, every, F.lit(0), stats("dep", counts[5]))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in [*[f"{n}_count" for n in counts], "origin_pending_count"]}
    return out.withColumns(zero).withColumn("origin_pending_share", F.when(F.col("__sched") > 0, F.col("origin_pending_count") / F.col("__sched"))).drop("__sched")


def weather(legs: DataFrame, hourly: DataFrame, values: list[str] = WEATHER, wet: str = "precipitation_mm") -> DataFrame:
    """The origin's full hour at the cutoff and its last three hours of ``wet``; the destination's full hour at the scheduled arrival; each with its hour."""
    seen = hourly.withColumn("ts", F.col("hour_minute"))
    out = hour_lookup(legs, seen.withColumnRenamed("place", "origin"), "origin", "cutoff", "hour_minute", [*values, "ts"], "loaded", "wx_o_")
    sums = full_hours_sum(hourly, "place", "hour_minute", wet, "loaded", 3, "wx_o_wet_3h").select(F.col("place").alias("__p"), F.col("hour_minute").alias("__h"), "wx_o_wet_3h")
    hour = F.floor(F.col("cutoff") / 60) * 60
    out = out.join(sums, (out["origin"] == sums["__p"]) & (hour == sums["__h"]), "left").drop("__p", "__h")
    return hour_lookup(out, seen.withColumnRenamed("place", "dest"), "dest", "sched_arr", "hour_minute", [*values, "ts"], "loaded", "wx_d_")


def window_events(legs: DataFrame, day: str, first_day: str, back: int = 2) -> DataFrame:
    """The legs that the features of a period need: from ``back`` days before its first day on, marked by whether they lie in it."""
    first = F.lit(first_day).cast("date")
    return legs.filter(F.col(day) >= F.date_sub(first, back)).withColumn("in_window", F.col(day) >= first)


def build(legs: DataFrame, hourly: DataFrame | None = None, targets: str = "completed", values: list[str] = WEATHER, wet: str = "precipitation_mm") -> DataFrame:
    """All features of the target legs. Targets are picked last: other legs are events of theirs."""
    known = with_cutoff(legs)
    out = congestion(inbound(known), known)
    if hourly is not None:
        out = weather(out, hourly, values, wet)
    return out.filter(F.col(targets))


def invariants(legs: DataFrame) -> DataFrame:
    """Counts that must be 0: a delay without its time or a time without its delay; events before their own cutoff; no time line."""
    c = with_cutoff(legs)
    bad = lambda cond: F.coalesce(F.sum(F.coalesce(cond, F.lit(False)).cast("long")), F.lit(0)).alias
    return c.agg(
        bad(F.col("actual_dep").isNull() != F.col("dep_delay").isNull())("dep_time_delay_mismatch"), bad(F.col("actual_arr").isNull() != F.col("arr_delay").isNull())("arr_time_delay_mismatch"),
        bad(F.col("actual_dep") < F.col("cutoff"))("departed_before_cutoff"), bad(F.col("actual_arr") < F.col("cutoff"))("arrived_before_cutoff"), bad(F.col("sched_dep").isNull())("no_time"),
    )
