"""Proofs that features use only what was known: counters, key cross-checks and an independent recompute."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_count

#: Words that a feature's name must not have.
FORBIDDEN = {"actual_dep", "actual_arr", "dep_delay", "arr_delay", "is_delayed", "status", "is_cancelled", "is_diverted"}


def timestamp_counters(features: DataFrame, cutoff: str, strict: list[str], pairs: list[tuple[str, str]], loose: list[str] = ()) -> DataFrame:
    """One aggregate: event times at or after the cutoff (after it, for ``loose``), and values without a time or the reverse."""
    late = sum((F.when(F.col(c) >= F.col(cutoff), 1).otherwise(0) for c in strict), F.lit(0))
    after = sum((F.when(F.col(c) > F.col(cutoff), 1).otherwise(0) for c in loose), F.lit(0))
    odd = sum(((F.col(v).isNull() != F.col(t).isNull()).cast("int") for v, t in pairs), F.lit(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return features.agg(F.count("*").alias("rows"), total(late).alias("at_or_after_cutoff"), total(after).alias("after_cutoff"), total(odd).alias("value_time_mismatch"), F.max(F.greatest(*[F.col(c) - F.col(cutoff) for c in strict])).alias("latest_minus_cutoff"))


def key_counters(features: DataFrame, legs: DataFrame) -> DataFrame:
    """Looks the recorded legs up again by key and compares; every counter must be 0. Four equi joins on the legs' key."""
    side = lambda p: legs.select(*[F.col(c).alias(f"{p}_{c}") for c in ("key", "vehicle", "sched_dep", "actual_dep", "actual_arr", "dep_delay", "arr_delay")])
    j = features.join(side("p"), F.col("prev_leg_key") == F.col("p_key"), "left").join(side("d"), F.col("ac_latest_dep_key") == F.col("d_key"), "left").join(side("a"), F.col("ac_latest_arr_key") == F.col("a_key"), "left")
    c = F.col("cutoff")
    before = lambda t: F.coalesce(F.col(t) < c, F.lit(False))
    return j.agg(
        as_count(F.col("inb_prev_dep_delay").isNotNull() != before("p_actual_dep")).alias("prev_dep_known"), as_count(F.col("inb_prev_dep_delay") != F.col("p_dep_delay")).alias("prev_dep_value"),
        as_count(F.col("inb_prev_arr_delay").isNotNull() != before("p_actual_arr")).alias("prev_arr_known"), as_count(F.col("inb_prev_arr_delay") != F.col("p_arr_delay")).alias("prev_arr_value"),
        as_count(F.col("p_sched_dep") >= F.col("sched_dep")).alias("prev_not_earlier"), as_count(F.col("d_key").isNotNull() & ~before("d_actual_dep")).alias("latest_dep_not_before"),
        as_count(F.col("a_key").isNotNull() & ~before("a_actual_arr")).alias("latest_arr_not_before"),
        as_count((F.col("prev_leg_key") == F.col("key")) | (F.col("ac_latest_dep_key") == F.col("key")) | (F.col("ac_latest_arr_key") == F.col("key"))).alias("own_leg_used"),
        as_count(F.col("prev_leg_key").isNotNull() & ~F.col("p_vehicle").eqNullSafe(F.col("vehicle"))).alias("prev_other_vehicle"),
    )


def events_after_cutoff(features: DataFrame, key: str, cutoff: str, strict: list[str], loose: list[str] = ()) -> DataFrame:
    """Key and cutoff of rows that use an event at the cutoff or later (after it, for ``loose``)."""
    bad = [F.col(c) >= F.col(cutoff) for c in strict] + [F.col(c) > F.col(cutoff) for c in loose]
    return features.filter(reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in bad])).select(key, cutoff)


def inbound_known_too_early(features: DataFrame, legs: DataFrame) -> DataFrame:
    """Keys of rows whose inbound delay is filled without its event before the cutoff (or missing with it), differs from the recorded one, or is the row's own."""
    p = legs.select(*[F.col(c).alias(f"p_{c}") for c in ("key", "actual_dep", "actual_arr", "dep_delay", "arr_delay")])
    j = features.join(p, F.col("prev_leg_key") == F.col("p_key"), "left")
    before = lambda t: F.coalesce(F.col(t) < F.col("cutoff"), F.lit(False))
    bad = [
        F.col("inb_prev_dep_delay").isNotNull() != before("p_actual_dep"), F.col("inb_prev_arr_delay").isNotNull() != before("p_actual_arr"),
        F.col("inb_prev_dep_delay") != F.col("p_dep_delay"), F.col("inb_prev_arr_delay") != F.col("p_arr_delay"), F.col("prev_leg_key") == F.col("key"),
    ]
    return j.filter(reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in bad])).select("key")


def disagrees(df: DataFrame, a: str, b: str, within: float, least: float) -> DataFrame:
    """``agreement``'s share if it is below ``least``; else no row."""
    return agreement(df, a, b, within).filter(F.col("share_within") < least).select("share_within")


def forbidden_columns(columns: list[str]) -> list[str]:
    return sorted(set(columns) & FORBIDDEN)


def agreement(df: DataFrame, a: str, b: str, within: float) -> DataFrame:
    """Rows where both are known, and the share that lie within a distance."""
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.agg(F.count("*").alias("rows"), F.avg((F.abs(F.col(a) - F.col(b)) <= within).cast("double")).alias("share_within"))


def recompute(sample: DataFrame, events: DataFrame, key: str, query_time: str, event_time: str, value: str, id_col: str, width: int) -> DataFrame:
    """Trailing count and mean by a plain range join: another plan than the window's, to compare with it.

    Time is cut into buckets as wide as the window, and each query asks the two that its window
    reaches, so that a hot key is dealt to many tasks and only rows of one key and bucket meet.
    """
    t, q = F.floor(F.col(event_time) / width), F.col(query_time)
    e = events.filter(F.col(value).isNotNull() & F.col(event_time).isNotNull()).select(F.col(key).alias("__k"), F.col(event_time).alias("__t"), F.col(value).cast("double").alias("__v"), t.alias("__b"))
    asked = sample.withColumn("__a", F.explode_outer(F.sequence(F.floor((q - width) / width), F.floor((q - 1) / width))))
    j = asked.join(e, (asked[key] == e["__k"]) & (asked["__a"] == e["__b"]) & (e["__t"] >= asked[query_time] - width) & (e["__t"] < asked[query_time]), "left")
    return j.groupBy(id_col).agg(F.count("__v").alias("naive_count"), F.avg("__v").alias("naive_mean"))


#: The values that are computed anew.
RECOMPUTED = [
    "inb_has_prev", "inb_sched_turn_min", "inb_prev_sched_dep_before_cutoff", "inb_prev_departed", "inb_prev_dep_delay", "inb_prev_arrived", "inb_prev_arr_delay", "inb_prev_overdue_min", "inb_known_delay_min", "inb_projected_slack_min", "ac_latest_dep_delay", "ac_latest_arr_delay",
    "origin_recent_dep_count", "origin_recent_dep_mean", "origin_pending_count", "origin_pending_share", "origin_recent_arr_mean", "dest_recent_arr_mean", "dest_recent_dep_mean", "carrier_recent_dep_mean", "all_recent_dep_mean",
]


#: Fixed value: rows that are computed anew, at any size of the table.
SAMPLE = 400


def sampled(df: DataFrame, key: str, n: int = SAMPLE) -> DataFrame:
    """``n`` rows, or all if there are fewer: those whose key's MD5 comes first, so that reruns take the same; of one key, which rows is open."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def naive(sample: DataFrame, legs: DataFrame, width: int = 120, lookback: int = 1440, low: int = -30, high: int = 300) -> DataFrame:
    """The ``RECOMPUTED`` values of the sampled rows (with their cutoff), by range joins: no window of ``operators.features`` is used.

    Time is cut into buckets as wide as each look-back and a row asks the two that it reaches, so that
    rows of one key meet in many tasks.
    """
    out = sample

    def meet(asks: dict[str, str], times: str, reach: int, until: str, events: DataFrame, values: list) -> DataFrame:
        """Aggregates ``values`` over the events of the same keys in ``[until - reach, until)``."""
        e = events.filter(F.col(times).isNotNull()).withColumn("__b", F.floor(F.col(times) / reach))
        e = e.select(*[F.col(c).alias(f"e_{c}") for c in e.columns])
        q = out.select("key", F.col(until).alias("__u"), *[F.col(a).alias(f"__k{i}") for i, a in enumerate(asks)]).filter("__u IS NOT NULL").withColumn("__a", F.explode(F.array_distinct(F.array(F.floor((F.col("__u") - reach) / reach), F.floor((F.col("__u") - 1) / reach)))))
        on = [q[f"__k{i}"] == e[f"e_{b}"] for i, b in enumerate(asks.values())] + [q["__a"] == e["e___b"], e[f"e_{times}"] >= q["__u"] - reach, e[f"e_{times}"] < q["__u"]]
        return q.join(e, on).groupBy("key").agg(*values)

    def add(found: DataFrame) -> DataFrame:
        return out.join(found.withColumnRenamed("key", "__key"), F.col("key") == F.col("__key"), "left").drop("__key")

    own = ["key", "sched_dep", "sched_arr", "actual_dep", "actual_arr", "dep_delay", "arr_delay"]
    out = add(meet({"vehicle": "vehicle"}, "sched_dep", lookback, "sched_dep", legs, [F.max_by(F.struct(*[F.col(f"e_{c}").alias(c) for c in own]), F.struct("e_sched_dep", "e_key")).alias("p")]))
    for kind in ("dep", "arr"):
        out = add(meet({"vehicle": "vehicle"}, f"actual_{kind}", lookback, "cutoff", legs, [F.max_by(f"e_{kind}_delay", F.struct(f"e_actual_{kind}", "e_key")).alias(f"ac_latest_{kind}_delay")]))
    clipped = lambda kind: F.avg(F.greatest(F.lit(low), F.least(F.lit(high), F.col(f"e_{kind}_delay"))).cast("double"))
    for a, b, kind, name in (("origin", "origin", "dep", "origin_recent_dep"), ("origin", "dest", "arr", "origin_recent_arr"), ("dest", "dest", "arr", "dest_recent_arr"), ("dest", "origin", "dep", "dest_recent_dep"), ("carrier", "carrier", "dep", "carrier_recent_dep"), (None, None, "dep", "all_recent_dep")):
        out = add(meet({a: b} if a else {}, f"actual_{kind}", width, "cutoff", legs.filter(F.col(f"{kind}_delay").isNotNull()), [F.count("*").alias(f"{name}_count"), clipped(kind).alias(f"{name}_mean")]))
    waits = F.col("e_actual_dep").isNull() | (F.col("e_actual_dep") >= F.col("__u"))
    out = add(meet({"origin": "origin"}, "sched_dep", width, "cutoff", legs, [F.count("*").alias("__sched"), F.count(F.when(waits, 1)).alias("origin_pending_count")]))
    c, p = F.col("cutoff"), F.col("p")
    before = lambda t: F.coalesce(t < c, F.lit(False))
    left, came, due = before(p["actual_dep"]), before(p["actual_arr"]), before(p["sched_dep"])
    known = F.when(came, p["arr_delay"]).when(left, F.greatest(p["dep_delay"], c - p["sched_arr"], F.lit(0))).when(due, c - p["sched_dep"]).otherwise(0)
    turn = F.col("sched_dep") - p["sched_arr"]
    counts = {n: F.coalesce(n, F.lit(0)) for n in ("origin_recent_dep_count", "origin_pending_count")}
    return out.withColumns(
        {
            "prev_leg_key": p["key"], "inb_has_prev": p.isNotNull().cast("int"), "inb_sched_turn_min": turn, "inb_prev_sched_dep_before_cutoff": due.cast("int"), "inb_prev_departed": left.cast("int"), "inb_prev_dep_delay": F.when(left, p["dep_delay"]), "inb_prev_arrived": came.cast("int"),
            "inb_prev_arr_delay": F.when(came, p["arr_delay"]), "inb_prev_overdue_min": F.when(due & ~left, c - p["sched_dep"]).otherwise(0), "inb_known_delay_min": known, "inb_projected_slack_min": F.when(p.isNotNull(), turn - F.greatest(known, F.lit(0))),
            "origin_pending_share": F.when(F.col("__sched") > 0, F.col("origin_pending_count") / F.col("__sched")),
        } | counts
    ).select("key", "prev_leg_key", *RECOMPUTED)


def differences(a: DataFrame, b: DataFrame, key: str, columns: list[str] = RECOMPUTED, tolerance: float = 1e-5) -> DataFrame:
    """Rows in both, values compared, and how many differ by more than the tolerance or are null on one side."""
    x = a.select(F.col(key).alias("__x"), *[F.col(c).cast("double").alias(f"x_{c}") for c in columns])
    y = b.select(F.col(key).alias("__y"), *[F.col(c).cast("double").alias(f"y_{c}") for c in columns])
    off = lambda c: F.coalesce(F.abs(F.col(f"x_{c}") - F.col(f"y_{c}")) > tolerance * F.greatest(F.lit(1.0), F.abs(f"y_{c}")), F.col(f"x_{c}").isNull() != F.col(f"y_{c}").isNull())
    return x.join(y, F.col("__x") == F.col("__y")).agg(F.count("*").alias("sampled"), F.lit(len(columns)).alias("values_compared"), F.coalesce(F.sum(sum((off(c).cast("int") for c in columns), F.lit(0))), F.lit(0)).cast("long").alias("mismatches"))
