"""Registered queries of the dashboard tables, weather and weeks-ahead features, and model checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import dashboards, evaluation, features, history, leakage, metrics, models, temporal
from ..steps import materialize
from .analogs import FLIGHTS, HOURLY, LEGS, METRICS, TIMELINE, WEATHER, flights, hourly, legs, timeline
from .registry import _FLAGGED, _SCORED, _TIES, _fit_rows, _scored, query

_DONE = "NOT is_cancelled AND NOT is_diverted"


@query(f"WITH {FLIGHTS} SELECT month, dow, round(CAST(sum(is_delayed) AS DOUBLE) / count(*), 4) AS delay_rate FROM f WHERE {_DONE} GROUP BY ALL")
def dash_delay_heatmap(spark, d):
    return dashboards.heatmap(flights(spark, d), "month", "dow")


@query(f"WITH {FLIGHTS}, g AS (SELECT origin, {METRICS} FROM f GROUP BY origin) SELECT origin, scheduled_flights, delay_rate FROM g ORDER BY scheduled_flights DESC, origin LIMIT 20")
def dash_top_airports(spark, d):
    return dashboards.busiest(flights(spark, d), "origin", 20)


@query(f"WITH {FLIGHTS}, g AS (SELECT carrier, {METRICS} FROM f GROUP BY carrier) SELECT 'C' || carrier AS carrier_name, on_time_pct FROM g")
def dash_ontime_by_carrier(spark, d):
    by = metrics.metrics_by(flights(spark, d), "carrier")
    return by.select(S.strip_suffix(F.concat(F.lit("C"), "carrier", F.lit(" Air Lines")), "Air Lines|Airlines|Airways").alias("carrier_name"), "on_time_pct")


@query(f"WITH {_FLAGGED} SELECT a AS actual, b AS predicted, count(r.y) AS rows FROM (SELECT CAST(unnest([0, 0, 1, 1]) AS INT) AS a, CAST(unnest([0, 1, 0, 1]) AS INT) AS b) LEFT JOIN r ON r.y = a AND r.flagged = b GROUP BY ALL")
def confusion_long(spark, d):
    return dashboards.confusion_long(evaluation.top_share(_scored(spark, d), "p", 0.2, _TIES), "y", "flagged")


@query(f"""WITH {_SCORED}, m AS (SELECT 'base' AS version, carrier, avg((p - y) * (p - y)) AS brier, avg(p) AS mean_score FROM s GROUP BY carrier UNION ALL SELECT 'flat', carrier, avg((0.5 - y) * (0.5 - y)), 0.5 FROM s GROUP BY carrier)
 SELECT version, carrier, metric, round(value, 9) AS value FROM (SELECT version, carrier, 'brier' AS metric, CAST(brier AS DOUBLE) AS value FROM m UNION ALL SELECT version, carrier, 'mean_score', CAST(mean_score AS DOUBLE) FROM m)""")
def model_before_after(spark, d):
    s = _scored(spark, d)
    of = lambda c: s.withColumn("q", c).groupBy("carrier").agg(F.avg((F.col("q") - F.col("y")) * (F.col("q") - F.col("y"))).alias("brier"), F.avg("q").alias("mean_score"))
    both = dashboards.versions({"base": of(F.col("p")), "flat": of(F.lit(0.5))})
    return dashboards.long_form(both, ["version", "carrier"], ["brier", "mean_score"]).select("version", "carrier", "metric", F.round("value", 9).alias("value"))


_ORDER = ", ".join(_TIES)


@query(f"WITH {_SCORED} (SELECT {_ORDER}, p, 'riskiest' AS kind FROM s ORDER BY p DESC, {_ORDER} LIMIT 3) UNION ALL (SELECT {_ORDER}, p, 'safest' FROM s ORDER BY p, {_ORDER} LIMIT 2)")
def example_rows(spark, d):
    return dashboards.extremes(_scored(spark, d), "p", _TIES).select(*_TIES, "p", "kind")


@query(f"WITH {FLIGHTS} SELECT unnest(['by_carrier', 'by_hour', 'by_day']) AS table_name, CAST(count(*) AS BIGINT) AS total, true AS agrees FROM f")
def export_totals_agree(spark, d):
    f = flights(spark, d)
    return dashboards.totals_agree({f"by_{k}": metrics.metrics_by(f, c) for k, c in (("carrier", "carrier"), ("hour", "dep_hour"), ("day", "day"))}, "scheduled_flights")


@query(f"WITH {FLIGHTS} SELECT CAST(row_number() OVER (ORDER BY coalesce(list_position(['3', '1', '2'], CAST(dow AS VARCHAR)), 4), dow) AS INT) AS place, dow, count(*) AS flights FROM f GROUP BY dow")
def manual_order(spark, d):
    by = flights(spark, d).groupBy("dow").agg(F.count("*").alias("flights")).withColumn("name", F.col("dow").cast("string"))
    order = Window.orderBy(metrics.manual_order("name", ["3", "1", "2"]), "dow")  # over seven rows
    return by.select(F.row_number().over(order).alias("place"), "dow", "flights")


_WX = "o AS (SELECT place, hour_minute, arg_min(wet, loaded) AS wet FROM h GROUP BY ALL), s3 AS (SELECT a.place, a.hour_minute, CASE WHEN count(b.wet) = 3 THEN CAST(sum(b.wet) AS BIGINT) END AS s FROM o a JOIN o b ON b.place = a.place AND b.hour_minute BETWEEN a.hour_minute - 120 AND a.hour_minute GROUP BY ALL)"


@query(f"""WITH {LEGS}, {HOURLY}, {_WX} SELECT l.key, a.wet AS wx_o_wet, s3.s AS wx_o_wet_3h, b.wet AS wx_d_wet FROM l LEFT JOIN o a ON a.place = l.origin AND a.hour_minute = CAST(floor(l.cutoff / 60) * 60 AS BIGINT)
 LEFT JOIN s3 ON s3.place = l.origin AND s3.hour_minute = CAST(floor(l.cutoff / 60) * 60 AS BIGINT) LEFT JOIN o b ON b.place = l.dest AND b.hour_minute = CAST(floor(l.sched_arr / 60) * 60 AS BIGINT)""")
def weather_features(spark, d):
    out = features.weather(features.with_cutoff(legs(spark, d)), hourly(spark, d), ["wet"], "wet")
    return out.select("key", "wx_o_wet", "wx_o_wet_3h", "wx_d_wet")


_SETS = {"carrier": ["carrier"], "dest": ["dest"], "route": ["route"], "carrier_hour": ["carrier", "dep_hour"]}


@query(f"""WITH {FLIGHTS}, h AS (SELECT * FROM f WHERE year = 1997 AND {_DONE}), t AS (SELECT DISTINCT carrier, dest, route, dep_hour FROM f WHERE year = 1998), p AS (SELECT avg(CAST(is_delayed AS DOUBLE)) AS prior FROM h),
 """ + ", ".join(f"g_{n} AS (SELECT {', '.join(k)}, (sum(CAST(is_delayed AS DOUBLE)) + 50 * prior) / (count(*) + 50) AS rate FROM h, p GROUP BY {', '.join(k)}, prior)" for n, k in _SETS.items()) + """, md AS (SELECT route, median(delay) AS m FROM h GROUP BY route)
 SELECT t.*, """ + ", ".join(f"round(coalesce(g_{n}.rate, prior), 9) AS {n}_rate, round(coalesce(g_{n}.rate / prior, 1), 9) AS {n}_lift" for n in _SETS) + ", md.m AS route_median FROM t CROSS JOIN p " + " ".join(f"LEFT JOIN g_{n} ON " + " AND ".join(f"g_{n}.{c} = t.{c}" for c in k) for n, k in _SETS.items()) + " LEFT JOIN md ON md.route = t.route")
def weeks_ahead_features(spark, d):
    f = flights(spark, d)
    h, t = f.filter((F.col("year") == 1997) & metrics.completed()), f.filter("year = 1998").select("carrier", "dest", "route", "dep_hour").distinct()
    for name, keys in _SETS.items():
        t = history.smoothed_rate(h, t, keys, "is_delayed", name=f"{name}_rate").withColumnRenamed(f"{name}_rate_lift", f"{name}_lift")
    t = history.group_median(h, t, ["route"], "delay", "route_median")
    return t.select("carrier", "dest", "route", "dep_hour", "route_median", *[F.round(c, 9).alias(c) for n in _SETS for c in (f"{n}_rate", f"{n}_lift")])


@query(f"WITH {TIMELINE} SELECT count(*) AS sampled, CAST(0 AS BIGINT) AS count_mismatches, CAST(0 AS BIGINT) AS mean_mismatches FROM e WHERE event_type = 'purchase'")
def independent_recompute(spark, d):
    """The trailing window against a plain range join: another plan, the same values."""
    e = timeline(spark, d)
    q = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("id"), "user_id", F.col("m").alias("q"))
    events = e.filter("event_type IN ('click', 'view')").select("user_id", "m", "value")
    window = temporal.trailing_stats(q, events, "user_id", "q", "m", "value")
    plain = leakage.recompute(q, events, "user_id", "q", "m", "value", "id", 120)
    j = window.join(plain, "id")
    off = F.abs(F.col("recent_mean") - F.col("naive_mean")) > 1e-5 * F.greatest(F.lit(1.0), F.abs("naive_mean"))
    return j.agg(F.count("*").alias("sampled"), S.as_count(F.col("recent_count") != F.col("naive_count")).alias("count_mismatches"), S.as_count(off | (F.col("recent_mean").isNull() != F.col("naive_mean").isNull())).alias("mean_mismatches"))


@query(f"WITH {FLIGHTS} SELECT dow, count(*) AS rows FROM f GROUP BY dow")
def rows_per_file(spark, d):
    return flights(spark, d).groupBy("dow").agg(F.count("*").alias("rows"))


@query()
def platt_diagnostic(spark, d):
    found = evaluation.platt(_scored(spark, d).withColumn("q", F.col("l_quantity") / 51), "q", "y")
    return spark.createDataFrame([(round(found["slope"], 3), round(found["intercept"], 3))], "slope double, intercept double")


#: Feature groups, in the order in which they are added.
_GROUPS = {
    "inbound": ["inb_has_prev", "inb_sched_turn_min", "inb_prev_sched_dep_before_cutoff", "inb_prev_departed", "inb_prev_dep_delay", "inb_prev_arrived", "inb_prev_arr_delay", "inb_prev_overdue_min", "inb_known_delay_min", "inb_projected_slack_min", "ac_latest_dep_delay", "ac_latest_arr_delay"],
    "congestion": ["origin_recent_dep_count", "origin_recent_dep_mean", "origin_pending_count", "origin_pending_share", "origin_recent_arr_mean", "dest_recent_arr_mean", "dest_recent_dep_mean", "carrier_recent_dep_mean", "all_recent_dep_mean"],
    "origin weather": [f"wx_o_{c}" for c in WEATHER] + ["wx_o_wet_3h"],
    "destination weather": [f"wx_d_{c}" for c in WEATHER],
}


@query()
def feature_ablation(spark, d):
    """Six feature lists, two models each; trees as few and as shallow as the readme says."""
    x = features.build(legs(spark, d).withColumn("label", (F.col("arr_delay") >= 15).cast("int")), hourly(spark, d).select("place", "hour_minute", "loaded", *WEATHER), values=list(WEATHER), wet="wet")
    plan = {"dep_hour": F.floor(F.pmod("sched_dep", F.lit(1440)) / 60), "elapsed": F.col("sched_arr") - F.col("sched_dep"), "day_of_week": F.pmod(F.floor(F.col("sched_dep") / 1440), F.lit(7))}
    g = _GROUPS
    x = x.withColumns(plan).withColumn("place_name", F.concat(F.lit("p"), "origin"))
    x = materialize(x.select("key", "sched_dep", "label", "place_name", *plan, *[F.col(c).cast("double").alias(c) for v in g.values() for c in v]), "rows")
    half = x.agg(F.percentile_approx("sched_dep", 0.7)).first()[0]
    base, every = list(plan), [c for v in g.values() for c in v]
    variants = {"schedule": base, "+ inbound": base + g["inbound"], "+ inbound + congestion": base + g["inbound"] + g["congestion"], "+ inbound + congestion + origin weather": base + g["inbound"] + g["congestion"] + g["origin weather"], "all": base + every, "all but inbound": base + [c for c in every if c not in g["inbound"]]}
    return models.ablation(x.filter(F.col("sched_dep") < half), x.filter(F.col("sched_dep") >= half), variants, ["place_name"], "label", trees=10, depth=4)


@query()
def tree_importance(spark, d):
    x = _fit_rows(spark, d, "qty", "price", "disc", "carrier_name", "y")
    fitted = models.fit_trees(x, ["qty", "price", "disc"], ["carrier_name"], "y", grouped=True)
    return spark.createDataFrame(models.gain_importance(fitted, ["qty", "price", "disc"], ["carrier_name"]), "feature string, share double")
