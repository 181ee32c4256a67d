"""Registered queries of the whole feature sets, and of the leakage checks on tables with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, history, leakage, metrics, quality
from ..steps import materialize
from .analogs import FLIGHTS, HOURLY, LEGS, WEATHER, flights, hourly, legs
from .registry import _CONG, _KNOWN, query

_LATEST = ", ".join(
    f"t_{k} AS (SELECT x.key, arg_max(o.key, (o.actual_{k}, o.key)) AS ac_latest_{k}_key, arg_max(o.{k}_delay, (o.actual_{k}, o.key)) AS ac_latest_{k}_delay, max(o.actual_{k}) AS ac_latest_{k}_ts FROM l x LEFT JOIN l o ON o.vehicle = x.vehicle AND o.actual_{k} >= x.cutoff - 1440 AND o.actual_{k} < x.cutoff GROUP BY x.key)"
    for k in ("dep", "arr")
)
_INBOUND = [
    "inb_has_prev", "inb_sched_turn_min", "inb_prev_sched_dep_before_cutoff", "inb_prev_departed", "inb_prev_dep_delay", "inb_prev_arrived", "inb_prev_arr_delay", "inb_prev_overdue_min", "inb_known_delay_min", "inb_projected_slack_min", "ac_latest_dep_delay", "ac_latest_arr_delay",
    "prev_leg_key", "ac_latest_dep_key", "ac_latest_arr_key", "inb_prev_dep_ts", "inb_prev_arr_ts", "ac_latest_dep_ts", "ac_latest_arr_ts",
]


@query(f"""{_KNOWN}, {_LATEST}, z AS (SELECT k.*, o.actual_dep AS pd, o.actual_arr AS pr, CAST(CASE WHEN arrived THEN ad WHEN departed THEN greatest(dd, k.cutoff - pa, 0) WHEN due THEN k.cutoff - ps ELSE 0 END AS BIGINT) AS known FROM k LEFT JOIN l o ON o.key = prev_leg_key)
 SELECT z.key, CAST(prev_leg_key IS NOT NULL AS BIGINT) AS inb_has_prev, CAST(sched_dep - pa AS BIGINT) AS inb_sched_turn_min, CAST(due AS BIGINT) AS inb_prev_sched_dep_before_cutoff, CAST(departed AS BIGINT) AS inb_prev_departed, CAST(CASE WHEN departed THEN dd END AS BIGINT) AS inb_prev_dep_delay,
 CAST(arrived AS BIGINT) AS inb_prev_arrived, CAST(CASE WHEN arrived THEN ad END AS BIGINT) AS inb_prev_arr_delay, CAST(CASE WHEN due AND NOT departed THEN cutoff - ps ELSE 0 END AS BIGINT) AS inb_prev_overdue_min, known AS inb_known_delay_min,
 CAST(CASE WHEN prev_leg_key IS NOT NULL THEN sched_dep - pa - greatest(known, 0) END AS BIGINT) AS inb_projected_slack_min, CAST(t_dep.ac_latest_dep_delay AS BIGINT) AS ac_latest_dep_delay, CAST(t_arr.ac_latest_arr_delay AS BIGINT) AS ac_latest_arr_delay,
 prev_leg_key, ac_latest_dep_key, ac_latest_arr_key, CAST(CASE WHEN departed THEN pd END AS BIGINT) AS inb_prev_dep_ts, CAST(CASE WHEN arrived THEN pr END AS BIGINT) AS inb_prev_arr_ts, ac_latest_dep_ts, ac_latest_arr_ts FROM z JOIN t_dep USING (key) JOIN t_arr USING (key)""")
def inbound_features(spark, d):
    out = features.inbound(features.with_cutoff(legs(spark, d)))
    return out.select("key", *[F.col(c).cast("long").alias(c) for c in _INBOUND])


_EVERY = [*_CONG, ("all_recent_dep", "true", "dep")]
_PEND = "p AS (SELECT x.key, count(o.key) AS scheduled, count(CASE WHEN o.actual_dep IS NULL OR o.actual_dep >= x.cutoff THEN o.key END) AS pending FROM l x LEFT JOIN l o ON o.origin = x.origin AND o.sched_dep >= x.cutoff - 120 AND o.sched_dep < x.cutoff GROUP BY x.key)"


@query(f"WITH {LEGS}, {_PEND}, " + ", ".join(f"t{i} AS (SELECT x.key, count(o.{k}_delay) AS c, max(o.actual_{k}) AS m, round(avg(CAST(CASE WHEN o.{k}_delay IS NOT NULL THEN greatest(-30, least(300, o.{k}_delay)) END AS DOUBLE)), 6) AS a FROM l x LEFT JOIN l o ON {on} AND o.actual_{k} >= x.cutoff - 120 AND o.actual_{k} < x.cutoff GROUP BY x.key)" for i, (_, on, k) in enumerate(_EVERY))
 + " SELECT p.key, pending AS origin_pending_count, round(CASE WHEN scheduled > 0 THEN CAST(pending AS DOUBLE) / scheduled END, 9) AS origin_pending_share, " + ", ".join(f"t{i}.c AS {n}_count, t{i}.a AS {n}_mean, t{i}.m AS {n}_last" for i, (n, _, _) in enumerate(_EVERY)) + " FROM p " + " ".join(f"JOIN t{i} ON t{i}.key = p.key" for i in range(len(_EVERY))))
def congestion_windows(spark, d):
    """All nine congestion features, with the counts behind the means and the last event of each window."""
    x = features.with_cutoff(legs(spark, d))
    out = features.congestion(x, x)
    return out.select("key", "origin_pending_count", F.round("origin_pending_share", 9).alias("origin_pending_share"), *[c for n, _, _ in _EVERY for c in (f"{n}_count", F.round(f"{n}_mean", 6).alias(f"{n}_mean"), f"{n}_last")])


_ONCE = "o AS (SELECT place, hour_minute, " + ", ".join(f"first({c} ORDER BY loaded) AS {c}" for c in WEATHER) + " FROM h GROUP BY ALL), s3 AS (SELECT a.place, a.hour_minute, CASE WHEN count(b.wet) = 3 THEN CAST(sum(b.wet) AS BIGINT) END AS s FROM o a JOIN o b ON b.place = a.place AND b.hour_minute BETWEEN a.hour_minute - 120 AND a.hour_minute GROUP BY ALL)"


@query(f"WITH {LEGS}, {HOURLY}, {_ONCE} SELECT l.key, " + ", ".join(f"CAST({t}.{c} AS BIGINT) AS wx_{s}_{c}" for t, s in (("a", "o"), ("b", "d")) for c in WEATHER) + """, s3.s AS wx_o_wet_3h, a.hour_minute AS wx_o_ts, b.hour_minute AS wx_d_ts FROM l LEFT JOIN o a ON a.place = l.origin AND a.hour_minute = CAST(floor(l.cutoff / 60) * 60 AS BIGINT)
 LEFT JOIN s3 ON s3.place = l.origin AND s3.hour_minute = CAST(floor(l.cutoff / 60) * 60 AS BIGINT) LEFT JOIN o b ON b.place = l.dest AND b.hour_minute = CAST(floor(l.sched_arr / 60) * 60 AS BIGINT)""")
def weather_all(spark, d):
    """All thirteen weather features and their hours."""
    out = features.weather(features.with_cutoff(legs(spark, d)), hourly(spark, d), list(WEATHER), "wet")
    names = [f"wx_{s}_{c}" for s in "od" for c in WEATHER] + ["wx_o_wet_3h", "wx_o_ts", "wx_d_ts"]
    return out.select("key", *[F.col(c).cast("long").alias(c) for c in names])


_RATES = {"carrier": ["carrier"], "origin": ["origin"], "dest": ["dest"], "route": ["route"], "carrier_route": ["carrier", "route"], "origin_hour": ["origin", "dep_hour"], "carrier_hour": ["carrier", "dep_hour"]}
_ROTATION, _MEDIANS = ["carrier", "flight_number", "origin"], {"hist_median_leg_of_day": "leg_of_day", "hist_median_turnaround": "turnaround"}
_PLAN = "day_of_week, dep_minute, arr_hour, elapsed, distance"
_ROWS = f"""WITH {FLIGHTS}, x AS (SELECT *, year * 12 + month - 1 AS mi, l_partkey % 40 AS flight_number, l_linenumber AS leg_of_day, CASE WHEN l_partkey % 5 <> 0 THEN CAST(trunc(l_quantity) AS INT) * 3 END AS turnaround,
 dow AS day_of_week, dep_hour * 60 + l_linenumber AS dep_minute, (dep_hour + l_linenumber) % 24 AS arr_hour, 60 + l_partkey % 200 AS elapsed, abs(origin - dest) * 100 AS distance FROM f),
 v AS (SELECT *, count(*) OVER (PARTITION BY origin, day, dep_hour) AS origin_deps_in_hour, count(*) OVER (PARTITION BY dest, day, arr_hour) AS dest_arrs_in_hour, count(*) OVER (PARTITION BY origin, day) AS origin_deps_in_day FROM x),
 c AS (SELECT * FROM x WHERE NOT is_cancelled AND NOT is_diverted), pr AS (SELECT mi + 1 AS m, avg(CAST(is_delayed AS DOUBLE)) AS prior FROM c GROUP BY mi)"""
_VOLUMES = ["origin_deps_in_hour", "dest_arrs_in_hour", "origin_deps_in_day"]


@query(_ROWS + "".join(f", g_{n} AS (SELECT {', '.join(k)}, mi + 1 AS m, sum(CAST(is_delayed AS DOUBLE)) AS s, count(*) AS n FROM c GROUP BY {', '.join(k)}, mi)" for n, k in _RATES.items()) + f", md AS (SELECT {', '.join(_ROTATION)}, mi + 1 AS m, " + ", ".join(f"median({v}) AS {n}" for n, v in _MEDIANS.items()) + f""" FROM c GROUP BY {', '.join(_ROTATION)}, mi)
 SELECT DISTINCT v.mi, v.carrier, v.origin, v.dest, v.flight_number, v.dep_hour, {_PLAN}, {', '.join(_VOLUMES)}, """ + ", ".join(f"round(CASE WHEN prior > 0 THEN (coalesce(g_{n}.s, 0) + 50 * prior) / (coalesce(g_{n}.n, 0) + 50) / prior END, 9) AS hist_rate_{n}" for n in _RATES) + ", " + ", ".join(f"CAST(md.{n} AS DOUBLE) AS {n}" for n in _MEDIANS) + " FROM v LEFT JOIN pr ON pr.m = v.mi " + " ".join(f"LEFT JOIN g_{n} ON g_{n}.m = v.mi AND " + " AND ".join(f"g_{n}.{c} = v.{c}" for c in k) for n, k in _RATES.items()) + " LEFT JOIN md ON md.m = v.mi AND " + " AND ".join(f"md.{c} = v.{c}" for c in _ROTATION) + " WHERE NOT v.is_cancelled AND NOT v.is_diverted")
def weeks_ahead_all(spark, d):
    """All eighteen numeric weeks-ahead features: schedule, volumes, seven lifts and two medians of the month before."""
    x = planned(spark, d)
    done = materialize(x.filter(metrics.completed()), "planned")  # history and target of one table
    plan = [c.strip() for c in _PLAN.split(",")]
    # what the month before says follows from these columns, so rows that are equal in them meet it once
    target = done.select("mi", "carrier", "origin", "dest", "route", "flight_number", "dep_hour", *plan, *_VOLUMES).distinct()
    out = history.previous_months(done, target, "mi", "is_delayed", {f"hist_rate_{n}": k for n, k in _RATES.items()}, _MEDIANS, _ROTATION)
    return out.select("mi", "carrier", "origin", "dest", "flight_number", "dep_hour", *plan, *_VOLUMES, *[F.round(f"hist_rate_{n}", 9).alias(f"hist_rate_{n}") for n in _RATES], *[F.col(n).cast("double").alias(n) for n in _MEDIANS])


def planned(spark, d):
    """Flights with what is planned of them: numbers, times, distance and the volumes around them."""
    from ..operators.rows import volumes

    f = flights(spark, d)
    x = f.withColumns(
        {
            "mi": F.col("year") * 12 + F.col("month") - 1, "flight_number": F.col("l_partkey") % 40, "leg_of_day": F.col("l_linenumber"), "turnaround": F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity").cast("int") * 3), "day_of_week": F.col("dow"),
            "dep_minute": F.col("dep_hour") * 60 + F.col("l_linenumber"), "arr_hour": (F.col("dep_hour") + F.col("l_linenumber")) % 24, "elapsed": F.lit(60) + F.col("l_partkey") % 200, "distance": F.abs(F.col("origin") - F.col("dest")) * 100,
        }
    )
    return volumes(x, origin_deps_in_hour=["origin", "day", "dep_hour"], dest_arrs_in_hour=["dest", "day", "arr_hour"], origin_deps_in_day=["origin", "day"])


# --- leakage checks on features with planted faults: every counter must count them

_FAULTS = """t AS (SELECT l.*, key - 1 - key % 3 AS prev_leg_key, CASE WHEN key % 7 > 0 THEN key - key % 2 END AS ac_latest_dep_key, CASE WHEN key % 5 > 0 THEN key - 2 END AS ac_latest_arr_key,
  CASE WHEN key % 4 > 0 THEN cutoff - 3 + key % 8 END AS inb_prev_dep_ts, CASE WHEN key % 6 > 0 THEN cutoff - key % 9 END AS inb_prev_arr_ts, CASE WHEN key % 3 > 0 THEN key % 40 END AS inb_prev_dep_delay, CASE WHEN key % 6 > 0 THEN key % 30 END AS inb_prev_arr_delay, cutoff + key % 3 - 1 AS wx_ts FROM l)"""


def _faulty(spark, d):
    """Legs with made-up features, wrong on purpose for many keys."""
    x = features.with_cutoff(legs(spark, d))
    k, c = F.col("key"), F.col("cutoff")
    return x.withColumns(
        {
            "prev_leg_key": k - 1 - k % 3, "ac_latest_dep_key": F.when(k % 7 > 0, k - k % 2), "ac_latest_arr_key": F.when(k % 5 > 0, k - 2), "inb_prev_dep_ts": F.when(k % 4 > 0, c - 3 + k % 8), "inb_prev_arr_ts": F.when(k % 6 > 0, c - k % 9),
            "inb_prev_dep_delay": F.when(k % 3 > 0, k % 40), "inb_prev_arr_delay": F.when(k % 6 > 0, k % 30), "wx_ts": c + k % 3 - 1,
        }
    )


@query(f"""WITH {LEGS}, {_FAULTS} SELECT count(*) AS rows, CAST(sum(CAST(coalesce(inb_prev_dep_ts >= cutoff, false) AS INT) + CAST(coalesce(inb_prev_arr_ts >= cutoff, false) AS INT)) AS BIGINT) AS at_or_after_cutoff, count(CASE WHEN wx_ts > cutoff THEN 1 END) AS after_cutoff,
 CAST(sum(CAST((inb_prev_dep_delay IS NULL) <> (inb_prev_dep_ts IS NULL) AS INT) + CAST((inb_prev_arr_delay IS NULL) <> (inb_prev_arr_ts IS NULL) AS INT)) AS BIGINT) AS value_time_mismatch, CAST(max(greatest(inb_prev_dep_ts - cutoff, inb_prev_arr_ts - cutoff)) AS BIGINT) AS latest_minus_cutoff FROM t""")
def planted_time_faults(spark, d):
    return leakage.timestamp_counters(_faulty(spark, d), "cutoff", ["inb_prev_dep_ts", "inb_prev_arr_ts"], [("inb_prev_dep_delay", "inb_prev_dep_ts"), ("inb_prev_arr_delay", "inb_prev_arr_ts")], ["wx_ts"]).withColumn("latest_minus_cutoff", F.col("latest_minus_cutoff").cast("long"))


_SIDES = "LEFT JOIN l p ON p.key = t.prev_leg_key LEFT JOIN l d ON d.key = t.ac_latest_dep_key LEFT JOIN l a ON a.key = t.ac_latest_arr_key"


@query(f"""WITH {LEGS}, {_FAULTS}, j AS (SELECT t.*, coalesce(p.actual_dep < t.cutoff, false) AS went, coalesce(p.actual_arr < t.cutoff, false) AS came, p.dep_delay AS pdd, p.arr_delay AS pad, p.sched_dep AS psd, p.vehicle AS pv, d.key AS dk, coalesce(d.actual_dep < t.cutoff, false) AS dwent, a.key AS ak, coalesce(a.actual_arr < t.cutoff, false) AS acame FROM t {_SIDES})
 SELECT count(CASE WHEN (inb_prev_dep_delay IS NOT NULL) <> went THEN 1 END) AS prev_dep_known, count(CASE WHEN inb_prev_dep_delay <> pdd THEN 1 END) AS prev_dep_value, count(CASE WHEN (inb_prev_arr_delay IS NOT NULL) <> came THEN 1 END) AS prev_arr_known, count(CASE WHEN inb_prev_arr_delay <> pad THEN 1 END) AS prev_arr_value,
 count(CASE WHEN psd >= sched_dep THEN 1 END) AS prev_not_earlier, count(CASE WHEN dk IS NOT NULL AND NOT dwent THEN 1 END) AS latest_dep_not_before, count(CASE WHEN ak IS NOT NULL AND NOT acame THEN 1 END) AS latest_arr_not_before,
 count(CASE WHEN coalesce(prev_leg_key = key, false) OR coalesce(ac_latest_dep_key = key, false) OR coalesce(ac_latest_arr_key = key, false) THEN 1 END) AS own_leg_used, count(CASE WHEN pv IS DISTINCT FROM vehicle THEN 1 END) AS prev_other_vehicle FROM j""")
def planted_key_faults(spark, d):
    return leakage.key_counters(_faulty(spark, d), legs(spark, d))


@query(f"""WITH {LEGS}, y AS (SELECT key, CASE WHEN key % 17 > 0 THEN sched_dep END AS sched_dep, cutoff, CASE WHEN key % 11 = 0 THEN cutoff - 1 WHEN key % 13 > 0 THEN actual_dep END AS actual_dep, CASE WHEN key % 19 = 0 THEN cutoff - 5 ELSE actual_arr END AS actual_arr, dep_delay, CASE WHEN key % 23 > 0 THEN arr_delay END AS arr_delay FROM l),
 z AS (SELECT *, sched_dep - 120 AS c FROM y) SELECT count(CASE WHEN (actual_dep IS NULL) <> (dep_delay IS NULL) THEN 1 END) AS dep_time_delay_mismatch, count(CASE WHEN (actual_arr IS NULL) <> (arr_delay IS NULL) THEN 1 END) AS arr_time_delay_mismatch, count(CASE WHEN actual_dep < c THEN 1 END) AS departed_before_cutoff, count(CASE WHEN actual_arr < c THEN 1 END) AS arrived_before_cutoff, count(CASE WHEN sched_dep IS NULL THEN 1 END) AS no_time FROM z""")
def planted_invariant_faults(spark, d):
    x, k = features.with_cutoff(legs(spark, d)), F.col("key")
    y = x.withColumns({"actual_dep": F.when(k % 11 == 0, F.col("cutoff") - 1).when(k % 13 > 0, F.col("actual_dep")), "actual_arr": F.when(k % 19 == 0, F.col("cutoff") - 5).otherwise(F.col("actual_arr")), "arr_delay": F.when(k % 23 > 0, F.col("arr_delay"))})
    return features.invariants(y.withColumn("sched_dep", F.when(k % 17 > 0, F.col("sched_dep"))))


@query(f"WITH {LEGS}, {_FAULTS} SELECT key, CAST(cutoff AS BIGINT) AS cutoff FROM t WHERE inb_prev_dep_ts >= cutoff OR inb_prev_arr_ts >= cutoff OR wx_ts > cutoff")
def events_after_cutoff(spark, d):
    """Rows that use an event of the cutoff or later: must be empty of real features."""
    return leakage.events_after_cutoff(_faulty(spark, d), "key", "cutoff", ["inb_prev_dep_ts", "inb_prev_arr_ts"], ["wx_ts"]).select("key", F.col("cutoff").cast("long").alias("cutoff"))


@query(f"WITH {LEGS}, {_FAULTS} SELECT t.key FROM t LEFT JOIN l p ON p.key = t.prev_leg_key WHERE (inb_prev_dep_delay IS NOT NULL) <> coalesce(p.actual_dep < t.cutoff, false) OR (inb_prev_arr_delay IS NOT NULL) <> coalesce(p.actual_arr < t.cutoff, false) OR inb_prev_dep_delay <> p.dep_delay OR inb_prev_arr_delay <> p.arr_delay OR t.prev_leg_key = t.key")
def inbound_known_too_early(spark, d):
    """Rows whose inbound delay is known before its event, or is not the recorded one: must be empty of real features."""
    return leakage.inbound_known_too_early(_faulty(spark, d), legs(spark, d))


@query(f"WITH {LEGS} SELECT share_within FROM (SELECT avg(CASE WHEN abs(actual_arr - actual_dep - (sched_arr - sched_dep)) <= 5 THEN 1.0::DOUBLE ELSE 0 END) AS share_within FROM l WHERE actual_arr IS NOT NULL AND actual_dep IS NOT NULL) WHERE share_within < 0.99")
def block_time_disagrees(spark, d):
    """The share of rows whose clock times agree with the duration, if it is too small: must be empty of right zones."""
    x = legs(spark, d).withColumns({"took": F.col("actual_arr") - F.col("actual_dep"), "planned": F.col("sched_arr") - F.col("sched_dep")})
    return leakage.disagrees(x, "took", "planned", 5, 0.99)


@query(f"""WITH {FLIGHTS}, s AS (SELECT CASE WHEN l_partkey % 9 > 0 THEN delay END AS delay, CASE WHEN l_partkey % 14 > 0 THEN CASE WHEN l_partkey % 10 = 0 THEN 1 - is_delayed ELSE is_delayed END END AS is_delayed FROM f WHERE NOT is_cancelled AND NOT is_diverted)
 SELECT unnest(['completed_have_delay', 'completed_have_flag', 'flag_agrees_with_delay']) AS check_name, 'error' AS severity, unnest([count(CASE WHEN delay IS NULL THEN 1 END), count(CASE WHEN is_delayed IS NULL THEN 1 END), count(CASE WHEN is_delayed IS NULL OR (coalesce(delay >= 15, false)) <> (is_delayed = 1) THEN 1 END)]) AS unexpected_count, unnest([count(CASE WHEN delay IS NULL THEN 1 END) = 0, count(CASE WHEN is_delayed IS NULL THEN 1 END) = 0, count(CASE WHEN is_delayed IS NULL OR (coalesce(delay >= 15, false)) <> (is_delayed = 1) THEN 1 END) = 0]) AS passed FROM s""")
def completed_checks(spark, d):
    """Delay and flag of completed rows, on rows with planted faults."""
    k = F.col("l_partkey")
    f = flights(spark, d).withColumns({"delay": F.when(k % 9 > 0, F.col("delay")), "is_delayed": F.when(k % 14 > 0, F.when(k % 10 == 0, 1 - F.col("is_delayed")).otherwise(F.col("is_delayed")))})
    return quality.row_checks(f, quality.completed_checks("delay", "is_delayed", metrics.completed()))


@query(f"WITH {FLIGHTS} SELECT origin, CAST(min(day) AS DATE) AS first_day, max(CAST(in_window AS INT)) AS in_window, count(*) AS rows FROM (SELECT *, day >= DATE '1997-06-01' AS in_window FROM f WHERE day >= DATE '1997-06-01' - 2) GROUP BY origin")
def event_lookback(spark, d):
    """Events from two days before the window on."""
    f = features.window_events(flights(spark, d), "day", "1997-06-01")
    return f.groupBy("origin").agg(F.min("day").alias("first_day"), F.max(F.col("in_window").cast("int")).alias("in_window"), F.count("*").alias("rows"))
