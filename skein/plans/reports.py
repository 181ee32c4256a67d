"""Registered queries of evaluations, published tables, charts and declared checks."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import dashboards, evaluation, features, history, leakage, metrics, models, quality, rows
from ..sources.published import Publication
from ..steps import materialize, shared_dir
from .analogs import FLIGHTS, LEGS, METRICS, flights, legs, table
from .registry import _CONF, _FLAGGED, _KNOWN, _SCORED, _TIES, _causes, _scored, query

_DONE = "NOT is_cancelled AND NOT is_diverted"


# --- rows and texts


@query(f"WITH {FLIGHTS}, c AS (SELECT origin AS place, 'city ' || (l_partkey % 7) AS city, 'S' || (l_suppkey % 5) AS state FROM f UNION SELECT dest, 'town ' || (l_partkey % 5), 'T' || (l_suppkey % 3) FROM f) SELECT place, min(city) AS city, min(state) AS state FROM c GROUP BY place")
def place_representative(spark, d):
    f = flights(spark, d).select("origin", "dest", F.concat(F.lit("city "), F.col("l_partkey") % 7).alias("a"), F.concat(F.lit("town "), F.col("l_partkey") % 5).alias("b"), F.concat(F.lit("S"), F.col("l_suppkey") % 5).alias("s"), F.concat(F.lit("T"), F.col("l_suppkey") % 3).alias("t"))
    return rows.representatives(rows.code_union(f, {"place": ["origin", "dest"], "city": ["a", "b"], "state": ["s", "t"]}), "place", ["city", "state"])


@query("SELECT n_nationkey, replace(CASE WHEN n_regionkey < 3 THEN 'US-' || n_name ELSE 'CA-' || n_name END, 'US-', '') AS state_code FROM nation")
def state_codes(spark, d):
    n = table(spark, d, "nation").withColumn("region", F.concat(F.when(F.col("n_regionkey") < 3, "US-").otherwise("CA-"), "n_name"))
    return n.select("n_nationkey", S.state_code("region").alias("state_code"))


@query(f"WITH {FLIGHTS}, r AS (SELECT (['A', 'B', 'C', 'D', 'E'])[CAST(l_partkey % 5 + 1 AS INT)] AS code FROM f) SELECT code, CASE code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather' WHEN 'C' THEN 'National Air System' WHEN 'D' THEN 'Security' END AS reason, count(*) AS rows FROM r GROUP BY code")
def cancellation_reasons(spark, d):
    code = F.element_at(F.array(*map(F.lit, "ABCDE")), (F.col("l_partkey") % 5 + 1).cast("int"))
    return flights(spark, d).groupBy(code.alias("code")).agg(F.count("*").alias("rows")).withColumn("reason", metrics.reason("code"))


@query(f"WITH {FLIGHTS} SELECT DISTINCT day, strftime(day, '%b %Y') AS month_label FROM f")
def month_labels(spark, d):
    return flights(spark, d).select("day").distinct().withColumn("month_label", S.month_label("day"))


@query(f"WITH {FLIGHTS} SELECT DISTINCT l_discount AS p, round(ln(greatest(1e-6, least(1 - 1e-6, l_discount)) / (1 - greatest(1e-6, least(1 - 1e-6, l_discount)))), 9) AS logit FROM f")
def logit_scores(spark, d):
    return flights(spark, d).select(F.col("l_discount").alias("p")).distinct().withColumn("logit", F.round(S.logit("p"), 9))


# --- evaluation


def _share(p):
    return f"r AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY p DESC, {', '.join(_TIES)}) <= round_even({p} * count(*) OVER (), 0) THEN 1 ELSE 0 END AS flagged FROM s)"


@query(f"WITH {_SCORED}, {_share(0.1)}{_CONF}")
def confusion_at_tenth(spark, d):
    return evaluation.top_share(_scored(spark, d), "p", 0.1, _TIES).agg(*evaluation.confusion("y", "flagged"))


_AREA = "g AS (SELECT p AS s, CAST(sum(y) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM s GROUP BY 1), k AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS c, sum(p) OVER () AS pp, sum(n) OVER () - sum(p) OVER () AS nn FROM g), ar AS (SELECT round(sum((n - p) * (tp - p / 2)) / max(pp * nn), 4) AS auc_roc, round(sum(p * tp / c) / max(pp), 4) AS auc_pr FROM k)"


@query(f"WITH {_SCORED}, {_AREA}, " + ", ".join(f"q{i} AS (WITH {_share(x)}{_CONF})" for i, x in enumerate((0.2, 0.1))) + " SELECT 0.2::DOUBLE AS share, q0.*, ar.* FROM q0, ar UNION ALL SELECT 0.1::DOUBLE, q1.*, ar.* FROM q1, ar")
def evaluation_at_shares(spark, d):
    return evaluation.shares(_scored(spark, d), "p", "y", _TIES)


_JUDGED = f"""{_KNOWN}, z AS (SELECT x.key, CASE WHEN x.arr_delay >= 15 THEN 1 ELSE 0 END AS y, CAST(CASE WHEN arrived THEN ad WHEN departed THEN greatest(dd, k.cutoff - pa, 0) WHEN due THEN k.cutoff - ps ELSE 0 END AS DOUBLE) AS known, k.sched_dep - pa AS turn, x.carrier, x.dest FROM k JOIN l x USING (key) WHERE x.completed AND x.arr_delay IS NOT NULL),
 hp AS (SELECT avg(CASE WHEN arr_delay >= 15 THEN 1.0::DOUBLE ELSE 0 END) AS prior FROM l WHERE NOT completed AND arr_delay IS NOT NULL), hg AS (SELECT carrier, dest, sum(CASE WHEN arr_delay >= 15 THEN 1.0::DOUBLE ELSE 0 END) AS s, count(*) AS n FROM l WHERE NOT completed AND arr_delay IS NOT NULL GROUP BY ALL),
 j AS (SELECT z.*, round((coalesce(s, 0) + 50 * prior) / (coalesce(n, 0) + 50), 9) AS rate FROM z CROSS JOIN hp LEFT JOIN hg USING (carrier, dest))"""


def _judged(spark, d):
    """Completed legs with their label, what was known of the inbound leg, its turn, and the carrier's and place's rate among other legs."""
    x = legs(spark, d).filter("arr_delay IS NOT NULL").withColumn("y", (F.col("arr_delay") >= 15).cast("int"))
    known = features.inbound(features.with_cutoff(legs(spark, d))).select("key", F.col("inb_known_delay_min").cast("double").alias("known"), F.col("inb_sched_turn_min").alias("turn"))
    rated = history.smoothed_rate(x.filter("NOT completed"), x.filter("completed"), ["carrier", "dest"], "y", name="rate").withColumn("rate", F.round("rate", 9))
    return rated.join(known, "key").select("key", "y", "known", "turn", "rate")


def _areas(source, score, where="true"):
    return f"SELECT round(sum((n - p) * (tp - p / 2)) / max(pp * nn), 4) AS auc_roc, round(sum(p * tp / c) / max(pp), 4) AS auc_pr FROM (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS c, sum(p) OVER () AS pp, sum(n) OVER () - sum(p) OVER () AS nn FROM (SELECT {score} AS s, CAST(sum(y) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM {source} WHERE {where} GROUP BY 1))"


@query(f"{_JUDGED} SELECT 'historical rate' AS model, * FROM ({_areas('j', 'rate')}) UNION ALL SELECT 'inbound delay', * FROM ({_areas('j', 'known')})")
def rules_as_scorers(spark, d):
    """Two rules that need no fitting, evaluated like models."""
    scored = models.rules(_judged(spark, d), {"historical rate": "rate", "inbound delay": "known"})
    out = evaluation.curve_metrics(scored, "score", "y", None, "model")
    return out.select("model", F.round("roc_auc", 4).alias("auc_roc"), F.round("average_precision", 4).alias("auc_pr"))


@query(f"{_JUDGED}, b AS (SELECT count(CASE WHEN turn < 20 THEN 1 END) AS excluded, round(avg(CASE WHEN turn < 20 THEN CAST(y AS DOUBLE) END), 4) AS excluded_rate, count(CASE WHEN NOT coalesce(turn < 20, false) THEN 1 END) AS kept, round(avg(CASE WHEN NOT coalesce(turn < 20, false) THEN CAST(y AS DOUBLE) END), 4) AS kept_rate FROM j) SELECT m.*, b.* FROM (SELECT 'rate' AS model, * FROM ({_areas('j', 'rate', 'NOT coalesce(turn < 20, false)')}) UNION ALL SELECT 'known', * FROM ({_areas('j', 'known', 'NOT coalesce(turn < 20, false)')})) m, b")
def robustness_subset(spark, d):
    """Without legs whose turn is too short to have been planned."""
    return evaluation.robustness(_judged(spark, d), ["rate", "known"], "y", "turn")


@query(f"WITH {_FLAGGED} SELECT {', '.join(_TIES)}, y, round(p, 5) AS probability FROM r WHERE flagged = 1 ORDER BY p DESC, {', '.join(_TIES)} LIMIT 500")
def first_flagged(spark, d):
    """The first 500 flagged rows, by score and key."""
    f = evaluation.top_share(_scored(spark, d), "p", 0.2, _TIES).filter("flagged = 1")
    return metrics.top_n(f, 500, F.desc("p"), *[F.asc(c) for c in _TIES]).select(*_TIES, "y", F.round("p", 5).alias("probability"))


@query(f"WITH {_FLAGGED} SELECT {', '.join(_TIES)}, day, carrier, y AS actual_delayed, round(p, 5) AS delay_probability, flagged AS predicted_delayed FROM r")
def predictions(spark, d):
    """What the table of predictions holds of each scored row."""
    f = evaluation.top_share(_scored(spark, d), "p", 0.2, _TIES)
    return f.select(*_TIES, "day", "carrier", F.col("y").alias("actual_delayed"), F.round("p", 5).alias("delay_probability"), F.col("flagged").alias("predicted_delayed"))


# --- published tables


_PUBLISHED = "scheduled_flights, cancelled_flights, diverted_flights, completed_flights, delayed_flights, CAST(round(CAST(100 * on_time_pct AS DECIMAL(12,4)), 1) AS DOUBLE) AS on_time_pct, CAST(round(CAST(100 * delay_rate AS DECIMAL(12,4)), 1) AS DOUBLE) AS delay_rate_pct, CAST(round(CAST(100 * cancellation_rate AS DECIMAL(12,4)), 2) AS DOUBLE) AS cancellation_rate_pct, avg_delay"


def _publish(name, key, where="true"):
    sql = f"WITH {FLIGHTS}, g AS (SELECT {key}, {METRICS} FROM f GROUP BY {key}) SELECT {key}, {_PUBLISHED} FROM g WHERE {where}"

    def run(spark, d):
        keys = [k.strip() for k in key.split(",")]
        return dashboards.published(metrics.metrics_by(flights(spark, d), *keys).filter(where), *keys)

    run.__name__, run.__doc__ = name, f"Published metrics by {key}."
    return query(sql)(run)


export_by_carrier = _publish("export_by_carrier", "carrier")
export_by_origin = _publish("export_by_origin", "origin", "completed_flights >= 100")
export_by_hour = _publish("export_by_hour", "dep_hour")
export_by_dow_month = _publish("export_by_dow_month", "month, dow")
export_daily = _publish("export_daily", "day")


@query(f"WITH {FLIGHTS}, r AS (SELECT route, {METRICS} FROM f GROUP BY ALL), k AS (SELECT *, rank() OVER (ORDER BY delay_rate DESC NULLS LAST, delayed_flights DESC, route) AS delay_rank FROM r WHERE completed_flights >= 5) SELECT delay_rank, route, {_PUBLISHED} FROM k WHERE delay_rank <= 20")
def export_top_routes(spark, d):
    """The twenty first ranks of the delayed routes."""
    top = metrics.top_routes(flights(spark, d), "route", 5).filter("delay_rank <= 20")
    return dashboards.published(top, "delay_rank", "route")


@query(f"WITH {FLIGHTS} SELECT 'C' || carrier AS carrier_name, dep_hour, count(*) AS completed_flights, CAST(sum(is_delayed) AS BIGINT) AS delayed_flights FROM f WHERE {_DONE} GROUP BY ALL")
def export_carrier_hour(spark, d):
    done = flights(spark, d).filter(metrics.completed())
    return done.groupBy(F.concat(F.lit("C"), "carrier").alias("carrier_name"), "dep_hour").agg(F.count("*").alias("completed_flights"), F.sum("is_delayed").cast("long").alias("delayed_flights"))


@query(f"WITH {_SCORED}, m AS (SELECT carrier, round(100 * avg(CAST(y AS DOUBLE)), 1) AS a, round(100 * avg(p), 1) AS b FROM s GROUP BY carrier) SELECT carrier, 'Actual delay rate' AS series, a AS rate_pct FROM m UNION ALL SELECT carrier, 'Mean predicted probability', b FROM m")
def export_model_by_carrier_long(spark, d):
    by = _scored(spark, d).groupBy("carrier").agg(F.round(100 * F.avg(F.col("y").cast("double")), 1).alias("Actual delay rate"), F.round(100 * F.avg("p"), 1).alias("Mean predicted probability"))
    return by.unpivot("carrier", ["Actual delay rate", "Mean predicted probability"], "series", "rate_pct")


_MODELS = f"WITH {_SCORED}, {_AREA}, {_share(0.2)}{_CONF.replace(' SELECT tn', ', e AS (SELECT tn')}), md AS (SELECT 'score' AS model, auc_pr, auc_roc, precision, recall, f1_score FROM e, ar)"


def _metrics_row(spark, d):
    of = evaluation.shares(_scored(spark, d), "p", "y", _TIES, (0.2,))
    return of.select(F.lit("score").alias("model"), "auc_pr", "auc_roc", "precision", "recall", "f1_score")


@query(f"{_MODELS} SELECT model, metric, value FROM (UNPIVOT md ON auc_pr, auc_roc, precision, recall, f1_score INTO NAME metric VALUE value)")
def export_model_metrics_long(spark, d):
    return dashboards.long_form(_metrics_row(spark, d), ["model"], ["auc_pr", "auc_roc", "precision", "recall", "f1_score"])


@query(f"{_MODELS}, b AS (SELECT avg(CAST(y AS DOUBLE)) AS base, avg(CAST(flagged AS DOUBLE)) AS share FROM r) SELECT 'Random' AS model, unnest(['AUC-PR', 'Precision', 'Recall']) AS metric, unnest([round(base, 4), round(base, 4), round(share, 4)]) AS value FROM b UNION ALL SELECT model, unnest(['AUC-PR', 'Precision', 'Recall']), unnest([auc_pr, precision, recall]) FROM md")
def dash_model_comparison(spark, d):
    """A model's metrics beside those of a random order that flags as many rows."""
    f = evaluation.top_share(_scored(spark, d), "p", 0.2, _TIES)
    base = f.agg(F.avg(F.col("y").cast("double")).alias("auc_pr"), F.avg(F.col("flagged").cast("double")).alias("recall")).withColumn("precision", F.col("auc_pr"))
    return dashboards.comparison(_metrics_row(spark, d), base)


@query(f"WITH {FLIGHTS} SELECT CAST(date_trunc('week', day + INTERVAL 1 DAY) - INTERVAL 1 DAY AS DATE) AS flight_week, round(CAST(sum(is_delayed) AS DOUBLE) / count(*), 4) AS delay_rate FROM f WHERE {_DONE} GROUP BY ALL")
def dash_weekly_delay(spark, d):
    done = flights(spark, d).filter(metrics.completed()).select(S.week_start("day").alias("flight_week"), "is_delayed", F.lit(1).alias("one"))
    return metrics.rate_of_sums(done, "is_delayed", "one", "flight_week").select("flight_week", F.col("rate").alias("delay_rate"))


@query(f"WITH {_SCORED} SELECT 'C' || carrier AS carrier_name, round(avg(CAST(y AS DOUBLE)), 4) AS actual_rate, round(avg(p), 4) AS predicted_rate FROM s GROUP BY carrier")
def dash_model_by_carrier(spark, d):
    return _scored(spark, d).groupBy(F.concat(F.lit("C"), "carrier").alias("carrier_name")).agg(F.round(F.avg(F.col("y").cast("double")), 4).alias("actual_rate"), F.round(F.avg("p"), 4).alias("predicted_rate"))


@query(f"WITH {FLIGHTS}, g AS (SELECT carrier, {METRICS} FROM f GROUP BY carrier) SELECT printf('%.2fM', CAST(sum(scheduled_flights) AS DOUBLE) / 1000000) AS total_flights, printf('%.1f%%', (1 - CAST(sum(delayed_flights) AS DOUBLE) / sum(completed_flights)) * 100) AS on_time, printf('%.1f min', sum(avg_delay * completed_flights) / sum(completed_flights)) AS avg_delay, arg_max('C' || carrier, (CAST(delayed_flights AS DOUBLE) / completed_flights, -carrier)) AS worst_carrier FROM g")
def dash_kpis(spark, d):
    by = metrics.metrics_by(flights(spark, d), "carrier")
    done = F.sum("completed_flights")
    return by.agg(
        S.millions(F.sum("scheduled_flights")).alias("total_flights"), S.percent(1 - F.sum("delayed_flights").cast("double") / done).alias("on_time"), F.format_string("%.1f min", metrics.weighted_mean("avg_delay", "completed_flights")).alias("avg_delay"),
        F.max_by(F.concat(F.lit("C"), "carrier"), F.struct((F.col("delayed_flights").cast("double") / F.col("completed_flights")).alias("r"), (-F.col("carrier")).alias("c"))).alias("worst_carrier"),
    )


# --- charts


@query(f"WITH {FLIGHTS}, g AS (SELECT dep_hour, {METRICS} FROM f GROUP BY dep_hour) SELECT printf('%02d:00', dep_hour) AS hour, CAST(round(CAST(100 * delay_rate AS DECIMAL(12,4)), 1) AS DOUBLE) AS delay_rate_pct FROM g")
def chart_hours(spark, d):
    by = dashboards.published(metrics.metrics_by(flights(spark, d), "dep_hour"), "dep_hour")
    return by.select(F.format_string("%02d:00", "dep_hour").alias("hour"), "delay_rate_pct")


@query(f"WITH {FLIGHTS}, g AS (SELECT day, {METRICS} FROM f GROUP BY day) SELECT day, CAST(round(CAST(100 * on_time_pct AS DECIMAL(12,4)), 1) AS DOUBLE) AS on_time_pct FROM g")
def chart_days(spark, d):
    return dashboards.published(metrics.metrics_by(flights(spark, d), "day"), "day").select("day", "on_time_pct")


@query(f"WITH {FLIGHTS}, g AS (SELECT carrier, {METRICS} FROM f GROUP BY carrier) SELECT 'C' || carrier AS carrier_name, CAST(round(CAST(100 * on_time_pct AS DECIMAL(12,4)), 1) AS DOUBLE) AS on_time_pct, CAST(row_number() OVER (ORDER BY CAST(round(CAST(100 * on_time_pct AS DECIMAL(12,4)), 1) AS DOUBLE) DESC NULLS LAST, carrier) AS INT) AS place FROM g")
def chart_carriers(spark, d):
    """Carriers by falling punctuality."""
    from pyspark.sql import Window

    by = dashboards.published(metrics.metrics_by(flights(spark, d), "carrier"), "carrier")
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("on_time_pct"), F.asc("carrier")))  # over carriers
    return by.select(F.concat(F.lit("C"), "carrier").alias("carrier_name"), "on_time_pct", place.alias("place"))


@query(f"WITH {FLIGHTS}, g AS (SELECT dest, {METRICS} FROM f GROUP BY dest), t AS (SELECT * FROM g ORDER BY scheduled_flights DESC, dest LIMIT 15) SELECT dest, delay_rate FROM t ORDER BY delay_rate DESC NULLS LAST, scheduled_flights DESC, dest LIMIT 5")
def chart_worst_of_busiest(spark, d):
    return dashboards.worst_of_busiest(metrics.metrics_by(flights(spark, d), "dest"), "dest", 15, 5)


@query(f"{_MODELS} SELECT model, auc_pr, auc_roc, precision, recall FROM md")
def chart_models(spark, d):
    return _metrics_row(spark, d).select("model", "auc_pr", "auc_roc", "precision", "recall")


@query(f"WITH {FLIGHTS}, x AS (SELECT day, carrier, l_linenumber AS v FROM f) SELECT 'sum' AS kind, CAST(carrier AS VARCHAR) AS k, CAST(sum(v) AS DOUBLE) AS v FROM x GROUP BY ALL UNION ALL SELECT 'avg', CAST(carrier AS VARCHAR), round(avg(CAST(v AS DOUBLE)), 9) FROM x GROUP BY ALL UNION ALL SELECT 'week', CAST(CAST(date_trunc('week', day + INTERVAL 1 DAY) - INTERVAL 1 DAY AS DATE) AS VARCHAR), CAST(sum(v) AS DOUBLE) FROM x GROUP BY 2 UNION ALL SELECT 'none', CAST(carrier AS VARCHAR), CAST(v AS DOUBLE) FROM x WHERE day < DATE '1992-03-01'")
def chart_kinds(spark, d):
    """A chart's numbers of each kind: rows, sums, means and weeks."""
    x = flights(spark, d).select("day", F.col("carrier").cast("string").alias("k"), F.col("l_linenumber").cast("double").alias("v"))
    of = lambda kind, df: df.select(F.lit(kind).alias("kind"), F.col(df.columns[0]).cast("string").alias("k"), F.round("v", 9).alias("v"))
    parts = [of("sum", dashboards.chart(x, "sum", "v", "k")), of("avg", dashboards.chart(x, "avg", "v", "k")), of("week", dashboards.chart(x.drop("k"), "week", "v", "day")), of("none", dashboards.chart(x.filter("day < '1992-03-01'"), "none", "v", "k"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- declared checks


_STATUS = ["On time", "Delayed 15+ min", "Cancelled", "Diverted"]
#: The star schema's declared tests, on the driver's tables.
SUITE = {
    "lines": {"l_orderkey": ["not_null", ("in_table", "orders", "o_orderkey")], "l_partkey": ["not_null", ("in_table", "part", "p_partkey")], "l_suppkey": ["not_null", ("in_table", "supplier", "s_suppkey")], "l_linenumber": ["not_null"], "l_quantity": ["not_null"], "l_discount": ["not_null"], "l_returnflag": ["not_null", ("in", ["A", "N", "R"])], "l_linestatus": ["not_null", ("in", ["O"])], "l_shipdate": ["not_null"]},
    "orders": {"o_orderkey": ["unique", "not_null"], "o_custkey": ["not_null", ("in_table", "customer", "c_custkey")], "o_orderstatus": ["not_null", ("in", ["F", "O"])], "o_orderdate": ["not_null"], "o_totalprice": [("warn", "not_null")]},
    "customer": {"c_custkey": ["unique", "not_null"], "c_nationkey": ["not_null", ("in_table", "nation", "n_nationkey")], "c_mktsegment": ["not_null", ("warn", ("in", ["BUILDING", "MACHINERY"]))]},
    "supplier": {"s_suppkey": ["unique", "not_null"], "s_nationkey": ["not_null", ("in_table", "nation", "n_nationkey")]},
    "part": {"p_partkey": ["unique", "not_null"], "p_name": ["not_null"], "p_size": [("warn", "not_null")]},
    "nation": {"n_nationkey": ["unique", "not_null"], "n_name": ["unique", "not_null"], "n_regionkey": ["not_null", ("in_table", "region", "r_regionkey")]},
    "region": {"r_regionkey": ["unique", "not_null"], "r_name": ["unique", "not_null"]},
    "status": {"status": ["not_null", ("in", _STATUS[:3])], "route": ["not_null", ("warn", "unique")]},
    "by_carrier": {"carrier": ["unique", "not_null", ("in_table", "nation", "n_nationkey")], "on_time_pct": ["not_null"]},
    "by_hour": {"dep_hour": ["unique", "not_null"]},
    "by_day": {"day": ["unique", "not_null"]},
}


def _suite_sql():
    """The declared tests as SQL, one query each."""
    ctes = f"WITH {FLIGHTS}, lines AS (SELECT * FROM lineitem), status AS (SELECT route, CASE WHEN is_cancelled THEN 'Cancelled' WHEN is_diverted THEN 'Diverted' WHEN is_delayed = 1 THEN 'Delayed 15+ min' ELSE 'On time' END AS status FROM f), " + ", ".join(f"{n} AS (SELECT {k}, {METRICS} FROM f GROUP BY {k})" for n, k in (("by_carrier", "carrier"), ("by_hour", "dep_hour"), ("by_day", "day")))
    parts = []
    for t, columns in SUITE.items():
        for c, tests in columns.items():
            for test in tests:
                severity, test = ("warn", test[1]) if isinstance(test, tuple) and test[0] == "warn" else ("error", test)
                kind = test if isinstance(test, str) else test[0]
                n = {
                    "not_null": f"SELECT count(*) FROM {t} WHERE {c} IS NULL", "in": f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({', '.join(map(repr, test[1]))})" if kind == "in" else "",
                    "unique": f"SELECT coalesce(CAST(sum(n) AS BIGINT), 0) FROM (SELECT count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE n > 1", "in_table": f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {test[2]} FROM {test[1]})" if kind == "in_table" else "",
                }[kind]
                parts.append(f"SELECT '{t}.{c} {kind}' AS check_name, '{severity}' AS severity, ({n}) AS unexpected_count")
    return f"{ctes} SELECT *, unexpected_count = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


@query(_suite_sql())
def declared_suite(spark, d):
    f = materialize(flights(spark, d).select("route", "carrier", "dep_hour", "day", "is_cancelled", "is_diverted", "is_delayed", "delay"), "flights")  # four tables are made of it
    t = {n: table(spark, d, n) for n in ("orders", "customer", "supplier", "part", "nation", "region")} | {"lines": table(spark, d, "lineitem"), "status": f.select("route", metrics.status().alias("status"))}
    t |= {f"by_{n}": metrics.metrics_by(f, k) for n, k in (("carrier", "carrier"), ("hour", "dep_hour"), ("day", "day"))}
    return quality.suite(t, SUITE)


# --- independent recompute


@query(f"""{_KNOWN}, q AS (SELECT * FROM l ORDER BY md5(CAST(key AS VARCHAR)), key LIMIT 400) SELECT q.key, count(o.dep_delay) AS origin_recent_dep_count, round(avg(CAST(CASE WHEN o.dep_delay IS NOT NULL THEN greatest(-30, least(300, o.dep_delay)) END AS DOUBLE)), 6) AS origin_recent_dep_mean,
 any_value(k.prev_leg_key) AS prev_leg_key, CAST(any_value(CASE WHEN arrived THEN ad WHEN departed THEN greatest(dd, k.cutoff - pa, 0) WHEN due THEN k.cutoff - ps ELSE 0 END) AS BIGINT) AS inb_known_delay_min FROM q JOIN k USING (key) LEFT JOIN l o ON o.origin = q.origin AND o.actual_dep >= q.cutoff - 120 AND o.actual_dep < q.cutoff GROUP BY q.key""")
def naive_features(spark, d):
    """Features of a sample of legs by plain range joins, the way one would write them down."""
    x = features.with_cutoff(legs(spark, d))
    out = leakage.naive(materialize(leakage.sampled(x, "key"), "sample"), x)
    return out.select("key", "origin_recent_dep_count", F.round("origin_recent_dep_mean", 6).alias("origin_recent_dep_mean"), "prev_leg_key", F.col("inb_known_delay_min").cast("long").alias("inb_known_delay_min"))


@query(f"WITH {LEGS} SELECT least(count(*), 400) AS sampled, 21 AS values_compared, CAST(0 AS BIGINT) AS mismatches FROM l")
def recompute_all_values(spark, d):
    """All twenty-one values of the sampled legs, naive against windows: values that differ by more than 1e-5 of their size."""
    x = features.with_cutoff(legs(spark, d))
    some = materialize(leakage.sampled(x, "key"), "sample")
    built = features.congestion(features.inbound(x), x).join(F.broadcast(some.select("key")), "key", "left_semi")
    return leakage.differences(built, leakage.naive(some, x), "key")


# --- published tables


_PUBLISHED = {"carrier": "carrier", "hour": "dep_hour", "day": "day"}


@query(f"WITH {FLIGHTS} " + " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST({k} AS VARCHAR) AS k, count(*) AS scheduled_flights, CAST(1 AS BIGINT) AS version FROM f GROUP BY {k}" for n, k in _PUBLISHED.items()))
def published_tables(spark, d):
    """Three tables published at once under checks, and read back as the manifest says."""
    p = Publication(spark, f"{shared_dir(spark)}/published-{uuid4().hex}")
    f = materialize(flights(spark, d).select("carrier", "dep_hour", "day", "is_cancelled", "is_diverted", "is_delayed", "delay"), "flights")
    total = f.count()
    sums = lambda t: quality.report(*[quality.row_checks(x.agg(F.sum("scheduled_flights").alias("n")), [quality.Check(f"{n} total", F.col("n") != total)]) for n, x in t.items()])
    version = p.publish({n: metrics.metrics_by(f, k) for n, k in _PUBLISHED.items()}, {n: [k] for n, k in _PUBLISHED.items()}, sums, buckets=4)
    parts = [p.read(n).select(F.lit(n).alias("table_name"), F.col(k).cast("string").alias("k"), "scheduled_flights", F.lit(version).cast("long").alias("version")) for n, k in _PUBLISHED.items()]
    return reduce(DataFrame.unionByName, parts)


_CHANGED = "o_orderkey % 40 = 7"


@query(f"""WITH old AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 3), new AS (SELECT o_orderkey, o_totalprice + CASE WHEN {_CHANGED} THEN 1 ELSE 0 END AS o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 IN (3, 7)),
 n AS (SELECT count(CASE WHEN o.o_orderkey IS NULL THEN 1 END) AS inserted, count(CASE WHEN o.o_orderkey IS NOT NULL AND (o.o_totalprice <> n.o_totalprice) THEN 1 END) AS changed FROM new n LEFT JOIN old o USING (o_orderkey)),
 t AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)) SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total, any_value(inserted) AS inserted, any_value(changed) AS changed FROM t, n GROUP BY o_orderstatus""")
def published_upsert(spark, d):
    """An upsert of new, changed and equal rows into a published table, with its counts."""
    p = Publication(spark, f"{shared_dir(spark)}/published-{uuid4().hex}")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    p.publish({"orders": orders.filter("o_orderkey % 10 <> 3")}, {"orders": ["o_orderkey"]}, buckets=16)
    inserted, changed = p.upsert("orders", orders.filter("o_orderkey % 10 IN (3, 7)").withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.expr(_CHANGED), 1).otherwise(0)))
    by = p.read("orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return by.select("*", F.lit(inserted).cast("long").alias("inserted"), F.lit(changed).cast("long").alias("changed"))
