"""Registered queries of the schedule analytics, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import evaluation, features, history, leakage, metrics, models, quality, rows, temporal
from ..session import ship
from ..sources.files import last_months
from ..steps import materialize
from .analogs import FLIGHTS, HOURLY, LEGS, METRICS, TIMELINE, ZONES, flights, hourly, legs, table, timeline

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        _queries[f.__name__] = run
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


# --- shared metrics


@query(f"WITH {FLIGHTS} SELECT n_name AS carrier_name, f.carrier, {METRICS} FROM f JOIN nation ON n_nationkey = carrier GROUP BY ALL")
def delay_metrics_by_carrier(spark, d):
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("carrier"), F.col("n_name").alias("carrier_name"))
    return metrics.metrics_by(flights(spark, d).join(names, "carrier"), "carrier_name", "carrier")


@query(f"WITH {FLIGHTS} SELECT origin, n_name, n_regionkey, r_name, {METRICS} FROM f JOIN nation ON n_nationkey = origin JOIN region ON r_regionkey = n_regionkey GROUP BY ALL")
def delay_metrics_by_origin(spark, d):
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return metrics.metrics_by(flights(spark, d).join(places, F.col("origin") == F.col("n_nationkey")), "origin", "n_name", "n_regionkey", "r_name")


@query(f"WITH {FLIGHTS} SELECT dep_hour, {METRICS} FROM f GROUP BY ALL")
def delay_metrics_by_hour(spark, d):
    return metrics.metrics_by(flights(spark, d), "dep_hour")


@query(f"WITH {FLIGHTS} SELECT month, dow, strftime(make_date(2000, month, 1), '%b') AS month_name, (['Mon','Tue','Wed','Thu','Fri','Sat','Sun'])[dow] AS day_name, {METRICS} FROM f GROUP BY ALL")
def delay_metrics_by_dow_month(spark, d):
    return metrics.metrics_by(flights(spark, d), "month", "dow", S.month_name("month").alias("month_name"), S.weekday_name("dow").alias("day_name"))


@query(f"WITH {FLIGHTS} SELECT day, {METRICS} FROM f GROUP BY ALL")
def delay_metrics_by_day(spark, d):
    return metrics.metrics_by(flights(spark, d), "day")


@query(f"WITH {FLIGHTS}, r AS (SELECT route, {METRICS} FROM f GROUP BY ALL) SELECT *, rank() OVER (ORDER BY delay_rate DESC NULLS LAST, delayed_flights DESC, route) AS delay_rank FROM r WHERE completed_flights >= 5")
def top_delayed_routes(spark, d):
    return metrics.top_routes(flights(spark, d), "route", 5)


_CAUSES = f"""WITH {FLIGHTS}, w AS (SELECT month, l_linenumber * 10 AS carrier_min, CAST(trunc(l_quantity) AS INT) AS weather_min, CASE WHEN delay % 7 <> 0 THEN delay % 60 END AS system_min FROM f WHERE NOT is_cancelled AND NOT is_diverted AND is_delayed = 1),
 u AS (SELECT month, 'carrier' AS cause, carrier_min AS minutes FROM w UNION ALL SELECT month, 'weather', weather_min FROM w UNION ALL SELECT month, 'system', system_min FROM w),
 g AS (SELECT month, cause, CAST(sum(minutes) AS BIGINT) AS minutes, count(CASE WHEN minutes > 0 THEN 1 END) AS flights FROM u GROUP BY ALL)"""


def _causes(spark, d):
    f = flights(spark, d).withColumns({"carrier_min": F.col("l_linenumber") * 10, "weather_min": F.col("l_quantity").cast("int"), "system_min": F.when(F.col("delay") % 7 != 0, F.col("delay") % 60)})
    return metrics.cause_minutes(f, "month", {"carrier": "carrier_min", "weather": "weather_min", "system": "system_min"})


@query(f"{_CAUSES} SELECT * FROM g")
def delay_causes_by_month(spark, d):
    return _causes(spark, d)


@query(f"{_CAUSES} SELECT month, " + ", ".join(f"round(coalesce(sum(CASE WHEN cause = '{c}' THEN minutes END), 0)::DOUBLE / 1000, 3) AS {c}" for c in ("carrier", "weather", "system")) + " FROM g GROUP BY month")
def pivot_causes(spark, d):
    return metrics.pivot_causes(_causes(spark, d), ["carrier", "weather", "system"])


@query(f"{_CAUSES} SELECT *, round(100.0::DOUBLE * minutes / sum(minutes) OVER (PARTITION BY month), 2) AS share_pct FROM g")
def share_of_total(spark, d):
    return metrics.share_of_total(_causes(spark, d), "minutes", "month")


@query(f"WITH {FLIGHTS} SELECT carrier, coalesce(n_name, CAST(carrier AS VARCHAR)) AS carrier_name, count(*) AS flights FROM f LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 15) ON n_nationkey = carrier GROUP BY ALL")
def dim_carrier(spark, d):
    known = table(spark, d, "nation").filter("n_nationkey < 15")
    counts = flights(spark, d).groupBy("carrier").agg(F.count("*").alias("flights"))
    return rows.named_lookup(counts, "carrier", known, "n_nationkey", "n_name", "carrier_name").select("carrier", "carrier_name", "flights")


@query(f"""WITH {FLIGHTS}, c AS (SELECT 'N' || origin AS code FROM f UNION SELECT 'N' || dest FROM f), p AS (SELECT 'N' || n_nationkey AS k, n_name FROM nation WHERE n_nationkey < 12), q AS (SELECT 'KN' || n_nationkey AS k, n_name FROM nation WHERE n_nationkey BETWEEN 8 AND 20)
 SELECT code, coalesce(p.n_name, q.n_name) AS n_name, CASE WHEN p.k IS NOT NULL THEN 'code' WHEN q.k IS NOT NULL THEN 'fallback' END AS matched_by FROM c LEFT JOIN p ON p.k = code LEFT JOIN q ON q.k = 'K' || code AND p.k IS NULL""")
def dim_airport_fallback(spark, d):
    codes = rows.code_union(flights(spark, d).select(F.concat(F.lit("N"), "origin").alias("a"), F.concat(F.lit("N"), "dest").alias("b")), {"code": ["a", "b"]})
    n = table(spark, d, "nation")
    return rows.fallback_lookup(codes, "code", n.filter("n_nationkey < 12").withColumn("k", F.concat(F.lit("N"), "n_nationkey")), "k", n.filter("n_nationkey BETWEEN 8 AND 20").withColumn("k", F.concat(F.lit("KN"), "n_nationkey")), "k", "K", ["n_name"])


@query(f"WITH {FLIGHTS} SELECT origin AS place, dest AS other FROM f UNION SELECT dest, origin FROM f")
def union_distinct(spark, d):
    return rows.code_union(flights(spark, d), {"place": ["origin", "dest"], "other": ["dest", "origin"]})


@query(f"WITH {FLIGHTS} SELECT carrier, dep_hour, count(*) AS flights, round(100.0::DOUBLE * avg(CAST(is_delayed AS DOUBLE)), 2) AS delayed_pct FROM f WHERE NOT is_cancelled AND NOT is_diverted GROUP BY ALL")
def carrier_hour_counts(spark, d):
    done = flights(spark, d).filter(metrics.completed())
    return done.groupBy("carrier", "dep_hour").agg(F.count("*").alias("flights"), F.round(100.0 * F.avg(F.col("is_delayed").cast("double")), 2).alias("delayed_pct"))


@query(f"WITH {FLIGHTS} SELECT CAST(date_trunc('week', day + INTERVAL 1 DAY) - INTERVAL 1 DAY AS DATE) AS week, CAST(sum(is_delayed) AS BIGINT) AS is_delayed, CAST(sum(1) AS BIGINT) AS flights, round(CAST(sum(is_delayed) AS DOUBLE) / sum(1), 4) AS rate FROM f GROUP BY ALL")
def weekly_rate(spark, d):
    f = flights(spark, d).select(S.week_start("day").alias("week"), "is_delayed", F.lit(1).alias("flights"))
    return metrics.rate_of_sums(f, "is_delayed", "flights", "week")


@query(f"WITH {FLIGHTS}, g AS (SELECT carrier, count(*) AS n, avg(CAST(delay AS DOUBLE)) AS a FROM f GROUP BY carrier) SELECT round(sum(a * n) / sum(n), 6) AS avg_delay FROM g")
def weighted_mean(spark, d):
    by = flights(spark, d).groupBy("carrier").agg(F.count("*").alias("n"), F.avg(F.col("delay").cast("double")).alias("a"))
    return by.agg(F.round(metrics.weighted_mean("a", "n"), 6).alias("avg_delay"))


@query(f"WITH {FLIGHTS}, g AS (SELECT carrier, {METRICS} FROM f GROUP BY carrier) SELECT carrier, delay_rate FROM g ORDER BY delay_rate DESC, carrier LIMIT 1")
def worst_carrier(spark, d):
    return metrics.top_n(metrics.metrics_by(flights(spark, d), "carrier"), 1, F.desc("delay_rate"), F.asc("carrier")).select("carrier", "delay_rate")


@query(f"WITH {FLIGHTS} SELECT dest, count(*) AS flights, CAST(rank() OVER (ORDER BY count(*) DESC, dest) AS BIGINT) AS place FROM f GROUP BY dest QUALIFY place <= 10")
def top_k(spark, d):
    top = metrics.top_n(flights(spark, d).groupBy("dest").agg(F.count("*").alias("flights")), 10, F.desc("flights"), F.asc("dest"))
    return top.withColumn("place", F.rank().over(Window.orderBy(F.desc("flights"), F.asc("dest"))).cast("long"))


@query(f"WITH {FLIGHTS}, g AS (SELECT carrier, {METRICS} FROM f GROUP BY carrier) SELECT carrier, 'cancellation_rate' AS metric, cancellation_rate AS value FROM g UNION ALL SELECT carrier, 'delay_rate', delay_rate FROM g UNION ALL SELECT carrier, 'on_time_pct', on_time_pct FROM g")
def unpivot_long(spark, d):
    return metrics.metrics_by(flights(spark, d), "carrier").unpivot("carrier", ["cancellation_rate", "delay_rate", "on_time_pct"], "metric", "value")


@query(f"WITH {FLIGHTS} SELECT printf('%.2fM', CAST(count(*) AS DOUBLE) / 1000000) AS total, printf('%.1f%%', avg(CAST(is_delayed AS DOUBLE)) * 100) AS delayed, printf('%.1f min', avg(CAST(delay AS DOUBLE))) AS avg_delay FROM f")
def kpi_text(spark, d):
    f = flights(spark, d)
    return f.agg(S.millions(F.count("*")).alias("total"), S.percent(F.avg(F.col("is_delayed").cast("double"))).alias("delayed"), F.format_string("%.1f min", F.avg(F.col("delay").cast("double"))).alias("avg_delay"))


@query(f"WITH {FLIGHTS} SELECT CASE WHEN is_cancelled THEN 'Cancelled' WHEN is_diverted THEN 'Diverted' WHEN is_delayed = 1 THEN 'Delayed 15+ min' ELSE 'On time' END AS status, count(*) AS flights FROM f GROUP BY ALL")
def status_case(spark, d):
    return flights(spark, d).groupBy(metrics.status().alias("status")).agg(F.count("*").alias("flights"))


@query("SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day, count(*) AS rows, count(DISTINCT o_custkey) AS customers FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'")
def date_range_totals(spark, d):
    o = table(spark, d, "orders").filter("o_orderdate >= TIMESTAMP_NTZ '1996-01-01' AND o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    return o.agg(F.min(F.col("o_orderdate").cast("date")).alias("first_day"), F.max(F.col("o_orderdate").cast("date")).alias("last_day"), F.count("*").alias("rows"), F.countDistinct("o_custkey").alias("customers"))


@query("SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m FROM orders GROUP BY ALL ORDER BY y DESC, m DESC LIMIT 4")
def last_four_months(spark, d):
    return spark.createDataFrame(last_months(table(spark, d, "orders"), "o_orderdate"), "y int, m int")


# --- rows


@query("SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, l_partkey DESC NULLS FIRST, l_suppkey, l_quantity, l_extendedprice) = 1")
def dedupe_latest(spark, d):
    cols = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return rows.keep_latest(table(spark, d, "lineitem").select(*cols), ["l_orderkey", "l_linenumber"], "l_shipdate", "l_partkey", F.asc_nulls_last("l_suppkey"), F.asc_nulls_last("l_quantity"), F.asc_nulls_last("l_extendedprice"))


@query("SELECT c_nationkey, c_custkey, c_mktsegment FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_mktsegment = 'BUILDING') DESC NULLS FIRST, CASE WHEN c_acctbal > 5000 THEN 1 WHEN c_acctbal > 0 THEN 2 ELSE 3 END, c_custkey) = 1")
def dedupe_priority(spark, d):
    order = [F.desc_nulls_first(F.col("c_mktsegment") == "BUILDING"), F.when(F.col("c_acctbal") > 5000, 1).when(F.col("c_acctbal") > 0, 2).otherwise(3).asc(), F.asc_nulls_last("c_custkey")]
    return rows.keep_first(table(spark, d, "customer"), ["c_nationkey"], order).select("c_nationkey", "c_custkey", "c_mktsegment")


@query(f"""WITH {TIMELINE}, v AS (SELECT event_id, CASE WHEN user_id % 9 <> 0 THEN user_id END AS vehicle, day, clock, clock + n % 50 AS arrives FROM e),
 k AS (SELECT event_id, CAST(row_number() OVER w AS INT) AS leg_of_day, count(*) OVER (PARTITION BY vehicle, day) AS legs_today, clock - lag(arrives) OVER w AS t FROM v WHERE vehicle IS NOT NULL WINDOW w AS (PARTITION BY vehicle, day ORDER BY clock, event_id))
 SELECT v.event_id, leg_of_day, legs_today, CASE WHEN t >= 0 THEN t END AS turnaround FROM v LEFT JOIN k USING (event_id)""")
def rotation_of_day(spark, d):
    v = timeline(spark, d).select("event_id", F.when(F.col("user_id") % 9 != 0, F.col("user_id")).alias("vehicle"), "day", "clock", (F.col("clock") + F.col("n") % 50).alias("arrives"))
    return rows.rotation(v, "vehicle", "day", "clock", "arrives", "event_id").select("event_id", "leg_of_day", "legs_today", "turnaround")


@query(f"WITH {TIMELINE} SELECT event_id, count(*) OVER (PARTITION BY user_id, day) AS in_day, count(*) OVER (PARTITION BY event_type, day, clock // 60) AS in_hour FROM e")
def partition_volumes(spark, d):
    e = timeline(spark, d).withColumn("hour", F.floor(F.col("clock") / 60))
    return rows.volumes(e, in_day=["user_id", "day"], in_hour=["event_type", "day", "hour"]).select("event_id", "in_day", "in_hour")


@query("SELECT l_orderkey, l_linenumber, l_partkey, md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), nullif(l_returnflag, 'N'), l_linestatus)) AS leg_key FROM lineitem")
def surrogate_key(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    return l.select("l_orderkey", "l_linenumber", "l_partkey", S.surrogate_key("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")), "l_linestatus").alias("leg_key"))


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN '2400' WHEN event_id % 50 = 1 THEN '' ELSE strftime(ts, '%H%M') END AS c FROM events), u AS (SELECT event_id, CASE WHEN c = '2400' THEN '2359' ELSE c END AS c FROM t)
 SELECT event_id, c AS clock_text, TRY_CAST(substr(c, 1, 2) AS INT) AS hour, TRY_CAST(substr(c, 1, 2) AS INT) * 60 + TRY_CAST(substr(c, 3, 2) AS INT) AS minute, nullif(c, '') AS text FROM u""")
def hhmm_parse(spark, d):
    e = table(spark, d, "events")
    raw = F.when(F.col("event_id") % 50 == 0, "2400").when(F.col("event_id") % 50 == 1, "").otherwise(F.date_format("ts", "HHmm"))
    c = e.select("event_id", S.clock_text(raw).alias("clock_text"))
    return c.select("event_id", "clock_text", S.clock_hour("clock_text").alias("hour"), S.clock_minutes("clock_text").alias("minute"), S.blank_to_null("clock_text").alias("text"))


@query(f"""WITH {TIMELINE}, z AS (SELECT unnest(range({len(ZONES)})) AS i, unnest({ZONES!r}) AS zone), j AS (SELECT e.*, zone FROM e LEFT JOIN z ON i = user_id % 6)
 SELECT event_id, timezone('UTC', timezone(zone, CAST(day AS TIMESTAMP) + to_minutes(CAST(clock AS INT)))) AS dep_utc, timezone('UTC', timezone(zone, CAST(day AS TIMESTAMP) + to_minutes(CAST(clock AS INT)))) + to_minutes(CAST(n % 300 AS INT)) AS arr_utc,
 timezone('UTC', timezone(zone, CAST(day AS TIMESTAMP) + to_minutes(CAST(clock AS INT)))) - INTERVAL 120 MINUTE AS cutoff_utc FROM j""")
def utc_timeline(spark, d):
    zones = spark.createDataFrame(list(enumerate(ZONES)), "i int, zone string")
    e = timeline(spark, d).join(zones, F.col("user_id") % 6 == F.col("i"), "left")
    dep = S.to_utc(S.local_timestamp("day", "clock"), "zone")
    return e.select("event_id", dep.alias("dep_utc"), (dep + S.minutes(F.col("n") % 300)).alias("arr_utc"), (dep - S.minutes(F.lit(120))).alias("cutoff_utc"))


@query(f"WITH {TIMELINE} SELECT event_id, CAST(day + coalesce(CAST(round((clock + x - a) / 1440.0) AS INT), 0) AS DATE) AS arr_day FROM (SELECT *, CASE WHEN event_id % 20 <> 0 THEN n % 600 END AS x, (clock + n % 600 + event_id % 90) % 1440 AS a FROM e)")
def arrival_date_inference(spark, d):
    e = timeline(spark, d).withColumn("x", F.when(F.col("event_id") % 20 != 0, F.col("n") % 600)).withColumn("a", (F.col("clock") + F.col("n") % 600 + F.col("event_id") % 90) % 1440)
    return e.select("event_id", S.arrival_day("day", "clock", "x", "a").alias("arr_day"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_join_missing(spark, d):
    return rows.missing_keys(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders").filter("o_orderstatus = 'F'"), "o_custkey").select("c_custkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'NEW' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders UNION ALL SELECT -o_orderkey, 'NEW', o_totalprice FROM orders WHERE o_orderkey % 25 = 0 AND o_orderkey > 0")
def upsert_latest(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.filter("o_orderkey % 10 = 0").unionByName(o.filter("o_orderkey % 25 = 0 AND o_orderkey > 0").withColumn("o_orderkey", -F.col("o_orderkey"))).withColumn("o_orderstatus", F.lit("NEW"))
    return rows.upsert(o, new, ["o_orderkey"])


@query("SELECT p_partkey, trim(regexp_replace(p_name, '\\s*(?:[a-z]+ [a-z]+)$', '')) AS short_name, regexp_full_match(p_brand, 'Brand#[0-9]+') AS is_brand, coalesce(p_size, 0) AS size, coalesce(p_size IN (1, 5, 10, 20, 30), false) AS listed FROM part")
def text_functions(spark, d):
    return table(spark, d, "part").select("p_partkey", S.strip_suffix("p_name", "[a-z]+ [a-z]+").alias("short_name"), S.full_match("p_brand", "Brand#[0-9]+").alias("is_brand"), F.coalesce("p_size", F.lit(0)).alias("size"), F.coalesce(F.col("p_size").isin(1, 5, 10, 20, 30), F.lit(False)).alias("listed"))


@query(f"WITH {TIMELINE}, v AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN n END AS a, CASE WHEN event_id % 4 <> 0 THEN n % 40 END AS b FROM e) SELECT event_id, a IS DISTINCT FROM b AS differs, (a IS NULL) <> (b IS NULL) AS one_null, coalesce(a < b, false) AS less, CASE WHEN a IS NOT NULL THEN greatest(-30, least(300, a)) END AS clipped FROM v")
def null_comparisons(spark, d):
    v = timeline(spark, d).select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("n")).alias("a"), F.when(F.col("event_id") % 4 != 0, F.col("n") % 40).alias("b"))
    return v.select("event_id", (~F.col("a").eqNullSafe(F.col("b"))).alias("differs"), (F.col("a").isNull() != F.col("b").isNull()).alias("one_null"), F.coalesce(F.col("a") < F.col("b"), F.lit(False)).alias("less"), S.clip("a", -30, 300).alias("clipped"))


# --- point in time


_ASOF = "{T}, q AS (SELECT * FROM e WHERE event_type = 'purchase'), o AS (SELECT * FROM e WHERE event_type IN ('click', 'view'))"


@query(f"WITH {_ASOF.format(T=TIMELINE)} SELECT q.event_id, arg_max(o.m, (o.m, o.event_id)) AS last_m, arg_max(o.event_id, (o.m, o.event_id)) AS last_event_id, arg_max(o.value, (o.m, o.event_id)) AS last_value FROM q LEFT JOIN o ON o.user_id = q.user_id AND o.m >= q.m - 1440 AND o.m < q.m GROUP BY q.event_id")
def asof_latest(spark, d):
    e = timeline(spark, d)
    q = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("id"), "user_id", F.col("m").alias("q"))
    out = temporal.asof_latest(q, e.filter("event_type IN ('click', 'view')"), "user_id", "q", "m", "event_id", ["value"])
    return out.select(F.col("id").alias("event_id"), "last_m", "last_event_id", "last_value")


@query(f"WITH {LEGS} SELECT x.key, arg_max(p.key, (p.sched_dep, p.key)) AS prev_key, arg_max(p.sched_dep, (p.sched_dep, p.key)) AS prev_sched_dep FROM l x LEFT JOIN l p ON p.vehicle = x.vehicle AND p.sched_dep >= x.sched_dep - 1440 AND p.sched_dep < x.sched_dep GROUP BY x.key")
def asof_previous(spark, d):
    x = legs(spark, d)
    out = temporal.asof_latest(x.select("key", "vehicle", "sched_dep"), x, "vehicle", "sched_dep", "sched_dep", "key", [], prefix="prev_")
    return out.select("key", "prev_key", "prev_sched_dep")


_TRAIL = "SELECT q.event_id, count(o.value) AS recent_count, max(CASE WHEN o.value IS NOT NULL THEN o.m END) AS recent_last, round(avg(o.value), 6) AS recent_mean FROM q LEFT JOIN o ON {on} o.m >= q.m - 120 AND o.m < q.m GROUP BY q.event_id"


def _trailing(spark, d, key):
    e = timeline(spark, d)
    q = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("id"), "user_id", F.col("m").alias("q"))
    out = temporal.trailing_stats(q, e.filter("event_type IN ('click', 'view')").select("user_id", "m", "value"), key, "q", "m", "value")
    return out.select(F.col("id").alias("event_id"), "recent_count", "recent_last", F.round("recent_mean", 6).alias("recent_mean"))


@query(f"WITH {_ASOF.format(T=TIMELINE)} {_TRAIL.format(on='o.user_id = q.user_id AND')}")
def trailing_window_key(spark, d):
    return _trailing(spark, d, "user_id")


@query(f"WITH {_ASOF.format(T=TIMELINE)} {_TRAIL.format(on='')}")
def trailing_window_global(spark, d):
    return _trailing(spark, d, None)


_PENDING = f"""WITH {LEGS}, p AS (SELECT x.key, count(o.key) AS scheduled, count(CASE WHEN o.actual_dep IS NULL OR o.actual_dep >= x.cutoff THEN o.key END) AS pending
 FROM l x LEFT JOIN l o ON o.origin = x.origin AND o.sched_dep >= x.cutoff - 120 AND o.sched_dep < x.cutoff GROUP BY x.key)"""


@query(f"{_PENDING} SELECT key, pending FROM p")
def pending_count(spark, d):
    x = features.with_cutoff(legs(spark, d))
    events = x.select("origin", F.col("sched_dep").alias("s"), F.col("actual_dep").alias("a"))
    return temporal.pending_count(x, events, "origin", "cutoff", "s", "a").select("key", "pending")


@query(f"{_PENDING} SELECT key, pending, scheduled, CASE WHEN scheduled > 0 THEN CAST(pending AS DOUBLE) / scheduled END AS pending_share FROM p")
def pending_share(spark, d):
    x = features.with_cutoff(legs(spark, d))
    events = x.select("origin", F.col("sched_dep").alias("s"), F.col("actual_dep").alias("a"))
    return temporal.pending_share(x, events, "origin", "cutoff", "s", "a").select("key", "pending", "scheduled", "pending_share")


@query(f"WITH {TIMELINE}, {HOURLY}, o AS (SELECT place, hour_minute, arg_min(wet, loaded) AS wet FROM h GROUP BY ALL) SELECT e.event_id, o.wet AS at_wet FROM e LEFT JOIN o ON place = e.event_id % 10 AND hour_minute = CAST(floor(e.m / 60) * 60 AS BIGINT)")
def hour_lookup(spark, d):
    q = timeline(spark, d).select("event_id", F.pmod("event_id", F.lit(10)).alias("place"), "m")
    return temporal.hour_lookup(q, hourly(spark, d), "place", "m", "hour_minute", ["wet"], "loaded").select("event_id", "at_wet")


@query(f"WITH {TIMELINE}, {HOURLY}, o AS (SELECT place, hour_minute, arg_min(wet, loaded) AS wet FROM h GROUP BY ALL) SELECT a.place, a.hour_minute, a.wet, CASE WHEN count(b.wet) = 3 THEN CAST(sum(b.wet) AS BIGINT) END AS sum_hours FROM o a JOIN o b ON b.place = a.place AND b.hour_minute BETWEEN a.hour_minute - 120 AND a.hour_minute GROUP BY a.place, a.hour_minute, a.wet")
def three_hour_sum(spark, d):
    return temporal.full_hours_sum(hourly(spark, d), "place", "hour_minute", "wet", "loaded")


_KNOWN = f"""WITH {LEGS}, p AS (SELECT x.key, arg_max(o.key, (o.sched_dep, o.key)) AS pk FROM l x LEFT JOIN l o ON o.vehicle = x.vehicle AND o.sched_dep >= x.sched_dep - 1440 AND o.sched_dep < x.sched_dep GROUP BY x.key),
 k AS (SELECT x.key, x.cutoff, x.sched_dep, o.key AS prev_leg_key, o.sched_dep AS ps, o.sched_arr AS pa, coalesce(o.actual_dep < x.cutoff, false) AS departed, coalesce(o.actual_arr < x.cutoff, false) AS arrived, coalesce(o.sched_dep < x.cutoff, false) AS due, o.dep_delay AS dd, o.arr_delay AS ad
 FROM l x JOIN p USING (key) LEFT JOIN l o ON o.key = p.pk)"""


@query(f"""{_KNOWN} SELECT key, prev_leg_key, CAST(prev_leg_key IS NOT NULL AS INT) AS inb_has_prev, CAST(departed AS INT) AS inb_prev_departed, CAST(arrived AS INT) AS inb_prev_arrived, CAST(CASE WHEN due AND NOT departed THEN cutoff - ps ELSE 0 END AS BIGINT) AS inb_prev_overdue_min,
 CAST(CASE WHEN arrived THEN ad WHEN departed THEN greatest(dd, cutoff - pa, 0) WHEN due THEN cutoff - ps ELSE 0 END AS BIGINT) AS inb_known_delay_min, sched_dep - pa AS inb_sched_turn_min FROM k""")
def known_delay(spark, d):
    out = features.inbound(features.with_cutoff(legs(spark, d)))
    return out.select("key", "prev_leg_key", "inb_has_prev", "inb_prev_departed", "inb_prev_arrived", F.col("inb_prev_overdue_min").cast("long").alias("inb_prev_overdue_min"), F.col("inb_known_delay_min").cast("long").alias("inb_known_delay_min"), "inb_sched_turn_min")


_CONG = [("origin_recent_dep", "o.origin = x.origin", "dep"), ("origin_recent_arr", "o.dest = x.origin", "arr"), ("dest_recent_arr", "o.dest = x.dest", "arr"), ("dest_recent_dep", "o.origin = x.dest", "dep"), ("carrier_recent_dep", "o.carrier = x.carrier", "dep")]


@query(f"WITH {LEGS}, " + ", ".join(f"t{i} AS (SELECT x.key, count(o.{k}_delay) AS c, round(avg(CAST(CASE WHEN o.{k}_delay IS NOT NULL THEN greatest(-30, least(300, o.{k}_delay)) END AS DOUBLE)), 6) AS a FROM l x LEFT JOIN l o ON {on} AND o.actual_{k} >= x.cutoff - 120 AND o.actual_{k} < x.cutoff GROUP BY x.key)" for i, (_, on, k) in enumerate(_CONG)) + " SELECT t0.key, t0.c AS origin_recent_dep_count, " + ", ".join(f"t{i}.a AS {n}_mean" for i, (n, _, _) in enumerate(_CONG)) + " FROM t0 " + " ".join(f"JOIN t{i} USING (key)" for i in range(1, len(_CONG))))
def congestion_features(spark, d):
    x = features.with_cutoff(legs(spark, d))
    out = features.congestion(x, x)
    return out.select("key", "origin_recent_dep_count", *[F.round(f"{n}_mean", 6).alias(f"{n}_mean") for n, _, _ in _CONG])


@query(f"""WITH {LEGS} SELECT count(*) AS rows, CAST(0 AS BIGINT) AS at_or_after_cutoff, CAST(0 AS BIGINT) AS after_cutoff, CAST(0 AS BIGINT) AS value_time_mismatch FROM l WHERE completed""")
def leakage_counters(spark, d):
    f = features.build(legs(spark, d))
    strict = ["inb_prev_dep_ts", "inb_prev_arr_ts", "ac_latest_dep_ts", "ac_latest_arr_ts", "origin_recent_dep_last", "origin_recent_arr_last", "dest_recent_arr_last", "dest_recent_dep_last", "carrier_recent_dep_last", "all_recent_dep_last"]
    pairs = [("inb_prev_dep_delay", "inb_prev_dep_ts"), ("inb_prev_arr_delay", "inb_prev_arr_ts"), ("ac_latest_dep_delay", "ac_latest_dep_ts"), ("ac_latest_arr_delay", "ac_latest_arr_ts")] + [(f"{n}_mean", f"{n}_last") for n in ("origin_recent_dep", "origin_recent_arr", "dest_recent_arr", "dest_recent_dep", "carrier_recent_dep", "all_recent_dep")]
    return leakage.timestamp_counters(f, "cutoff", strict, pairs).drop("latest_minus_cutoff")


@query("SELECT " + ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in ("prev_dep_known", "prev_dep_value", "prev_arr_known", "prev_arr_value", "prev_not_earlier", "latest_dep_not_before", "latest_arr_not_before", "own_leg_used", "prev_other_vehicle")))
def key_cross_check(spark, d):
    x = legs(spark, d)
    return leakage.key_counters(features.inbound(features.with_cutoff(x)), x)


@query(f"WITH {LEGS} SELECT CAST(count(CASE WHEN actual_dep < cutoff THEN 1 END) AS BIGINT) AS departed_before_cutoff, CAST(count(CASE WHEN actual_arr < cutoff THEN 1 END) AS BIGINT) AS arrived_before_cutoff, CAST(0 AS BIGINT) AS dep_time_delay_mismatch, CAST(0 AS BIGINT) AS arr_time_delay_mismatch, CAST(0 AS BIGINT) AS no_time FROM l")
def feature_invariants(spark, d):
    return features.invariants(legs(spark, d))


@query(f"WITH {LEGS} SELECT count(*) AS rows, avg(CASE WHEN abs(actual_dep - sched_dep) <= 5 THEN 1.0::DOUBLE ELSE 0 END) AS share_within FROM l WHERE actual_dep IS NOT NULL")
def block_time_agreement(spark, d):
    return leakage.agreement(legs(spark, d), "actual_dep", "sched_dep", 5)


# --- history


@query(f"""WITH {FLIGHTS}, p AS (SELECT avg(CAST(is_delayed AS DOUBLE)) AS prior FROM f), g AS (SELECT route, sum(CAST(is_delayed AS DOUBLE)) AS s, count(*) AS n FROM f GROUP BY route)
 SELECT route, round((s + 50 * prior) / (n + 50), 9) AS rate, round((s + 50 * prior) / (n + 50) / prior, 9) AS lift FROM g, p""")
def smoothed_rate_lift(spark, d):
    return history.group_rates(flights(spark, d), ["route"], "is_delayed").select("route", F.round("rate", 9).alias("rate"), F.round("lift", 9).alias("lift"))


@query(f"WITH {FLIGHTS}, h AS (SELECT route, median(delay) AS median FROM f WHERE year < 1998 GROUP BY route), t AS (SELECT DISTINCT route FROM f WHERE year >= 1998) SELECT t.route, h.median FROM t LEFT JOIN h USING (route)")
def group_median(spark, d):
    f = flights(spark, d)
    return history.group_median(f.filter("year < 1998"), f.filter("year >= 1998").select("route").distinct(), ["route"], "delay")


@query(f"""WITH {FLIGHTS}, x AS (SELECT carrier, year * 12 + month - 1 AS mi, is_delayed FROM f), p AS (SELECT mi + 1 AS mi, avg(CAST(is_delayed AS DOUBLE)) AS prior FROM x GROUP BY mi), g AS (SELECT carrier, mi + 1 AS mi, sum(CAST(is_delayed AS DOUBLE)) AS s, count(*) AS n FROM x GROUP BY ALL),
 k AS (SELECT DISTINCT carrier, mi FROM x) SELECT k.carrier, k.mi, round((coalesce(s, 0) + 50 * prior) / (coalesce(n, 0) + 50), 9) AS prev_rate, round((coalesce(s, 0) + 50 * prior) / (coalesce(n, 0) + 50) / prior, 9) AS prev_lift FROM k LEFT JOIN p ON p.mi = k.mi LEFT JOIN g ON g.mi = k.mi AND g.carrier = k.carrier""")
def prev_month_history(spark, d):
    x = flights(spark, d).select("carrier", S.month_index("day").alias("mi"), "is_delayed")
    out = history.previous_month(x, ["carrier"], "mi", "is_delayed")
    return out.groupBy("carrier", "mi").agg(F.round(F.max("prev_rate"), 9).alias("prev_rate"), F.round(F.max("prev_lift"), 9).alias("prev_lift"))


# --- quality


@query("""WITH c AS (
 SELECT 'l_shipdate_not_null' AS check_name, 'error' AS severity, count(CASE WHEN l_shipdate IS NULL THEN 1 END) AS unexpected_count, 0.0 AS share, count(*) AS n FROM lineitem
 UNION ALL SELECT 'flag_letter', 'error', count(CASE WHEN NOT regexp_full_match(l_returnflag, '[A-Z]') THEN 1 END), 0.0, count(*) FROM lineitem
 UNION ALL SELECT 'status_in_set', 'error', count(CASE WHEN l_linestatus NOT IN ('F') THEN 1 END), 0.0, count(*) FROM lineitem
 UNION ALL SELECT 'quantity_plausible', 'warn', count(CASE WHEN NOT l_quantity BETWEEN 2 AND 50 THEN 1 END), 0.5, count(*) FROM lineitem
 UNION ALL SELECT 'no_duplicates', 'error', coalesce((SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1), 0), 0.0, 0
 UNION ALL SELECT 'supplier_known', 'error', (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 <> 0)), 0.0, 0
 UNION ALL SELECT 'rows_per_mode', 'error', (SELECT count(*) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_linenumber) WHERE NOT n BETWEEN 10 AND 100000000), 0.0, 0
 UNION ALL SELECT 'discount_mean', 'warn', (SELECT CASE WHEN avg(l_discount) BETWEEN 0.0 AND 0.08 THEN 0 ELSE 1 END FROM lineitem), 0.0, 0)
 SELECT check_name, severity, unexpected_count, unexpected_count <= share * n AS passed FROM c""")
def quality_report(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    checks = [quality.not_null("l_shipdate"), quality.matches("l_returnflag", "[A-Z]", "flag_letter"), quality.one_of("l_linestatus", ["F"], "status_in_set"), quality.between("l_quantity", 2, 50, "quantity_plausible", quality.WARN, 0.5)]
    return quality.report(
        quality.row_checks(l, checks), quality.unique(l, ["l_orderkey", "l_linenumber"], "no_duplicates"), quality.related(l, "l_suppkey", table(spark, d, "supplier").filter("s_suppkey % 7 <> 0"), "s_suppkey", "supplier_known"),
        quality.group_counts(l, "l_linenumber", 10, 100_000_000, "rows_per_mode"), quality.mean_between(l, F.col("l_discount"), 0.0, 0.08, "discount_mean"),
    )


@query("SELECT 'customer_known' AS check_name, 'warn' AS severity, count(*) AS unexpected_count, count(*) = 0 AS passed FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def relationship_check(spark, d):
    return quality.related(table(spark, d, "orders"), "o_custkey", table(spark, d, "customer").filter("c_acctbal > 0"), "c_custkey", "customer_known", quality.WARN)


# --- evaluation

_SCORED = f"{FLIGHTS}, s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, day, carrier, is_delayed AS y, l_discount AS p FROM f WHERE NOT is_cancelled AND NOT is_diverted)"


def _scored(spark, d):
    f = flights(spark, d).filter(metrics.completed())
    return f.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "day", "carrier", F.col("is_delayed").alias("y"), F.col("l_discount").alias("p"))


_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_CURVE = f"WITH {_SCORED}, g AS (SELECT p AS s, CAST(sum(y) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM s GROUP BY 1), c AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS c, sum(p) OVER () AS pp, sum(n) OVER () - sum(p) OVER () AS nn FROM g)"


@query(f"{_CURVE} SELECT round(sum((n - p) * (tp - p / 2)) / max(pp * nn), 9) AS roc_auc FROM c")
def roc_auc(spark, d):
    return evaluation.curve_metrics(_scored(spark, d), "p", "y").select(F.round("roc_auc", 9).alias("roc_auc"))


@query(f"{_CURVE} SELECT round(sum(p * tp / c) / max(pp), 9) AS average_precision FROM c")
def average_precision(spark, d):
    return evaluation.curve_metrics(_scored(spark, d), "p", "y").select(F.round("average_precision", 9).alias("average_precision"))


_FLAGGED = f"{_SCORED}, r AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY p DESC, {', '.join(_TIES)}) <= round_even(0.2 * count(*) OVER (), 0) THEN 1 ELSE 0 END AS flagged FROM s)"


@query(f"WITH {_FLAGGED} SELECT {', '.join(_TIES)}, flagged FROM r")
def top_share_flags(spark, d):
    return evaluation.top_share(_scored(spark, d), "p", 0.2, _TIES).select(*_TIES, "flagged")


_CONF = """, c AS (SELECT count(CASE WHEN y = 0 AND flagged = 0 THEN 1 END) AS tn, count(CASE WHEN y = 0 AND flagged = 1 THEN 1 END) AS fp, count(CASE WHEN y = 1 AND flagged = 0 THEN 1 END) AS fn, count(CASE WHEN y = 1 AND flagged = 1 THEN 1 END) AS tp FROM r)
 SELECT tn, fp, fn, tp, round(CAST(tp AS DOUBLE) / (tp + fp), 4) AS precision, round(CAST(tp AS DOUBLE) / (tp + fn), 4) AS recall, round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 4) AS f1_score, round(CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp), 4) AS accuracy, round(CAST(tp + fp AS DOUBLE) / (tn + fp + fn + tp), 4) AS predicted_positive_rate FROM c"""


@query(f"WITH {_FLAGGED}{_CONF}")
def confusion_at_share(spark, d):
    return evaluation.top_share(_scored(spark, d), "p", 0.2, _TIES).agg(*evaluation.confusion("y", "flagged"))


@query(f"""WITH {FLIGHTS}, s AS (SELECT is_delayed AS y, CASE WHEN l_linenumber <> 3 THEN CAST(trunc(l_quantity) AS INT) * 4 END AS k FROM f), t AS (SELECT unnest(range(0, 181, 5)) AS threshold),
 c AS (SELECT threshold, count(CASE WHEN y = 0 AND NOT hit THEN 1 END) AS tn, count(CASE WHEN y = 0 AND hit THEN 1 END) AS fp, count(CASE WHEN y = 1 AND NOT hit THEN 1 END) AS fn, count(CASE WHEN y = 1 AND hit THEN 1 END) AS tp FROM (SELECT threshold, y, coalesce(CASE WHEN threshold > 0 THEN k >= threshold ELSE k > 0 END, false) AS hit FROM s, t) GROUP BY threshold)
 SELECT CAST(threshold AS INT) AS threshold, tn, fp, fn, tp, round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END, 4) AS precision, round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END, 4) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END, 4) AS f1_score FROM c""")
def threshold_sweep(spark, d):
    f = flights(spark, d).select(F.col("is_delayed").alias("y"), F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("int") * 4).alias("k"))
    return evaluation.threshold_sweep(f, "y", "k", list(range(0, 181, 5)))


@query(f"WITH {_SCORED}, r AS (SELECT *, row_number() OVER (ORDER BY p, {', '.join(_TIES)}) AS r, count(*) OVER () AS n FROM s) SELECT CAST(greatest(ceil((r - 1) * 10 / (n - 1)::DOUBLE), 1) AS INT) AS decile, count(*) AS rows, round(avg(p), 4) AS mean_predicted, round(avg(CAST(y AS DOUBLE)), 4) AS actual_rate FROM r GROUP BY 1")
def decile_calibration(spark, d):
    return evaluation.calibration(_scored(spark, d), "p", "y", _TIES)


@query(f"WITH {_SCORED} SELECT carrier, count(*) AS rows, round(avg((p - y) * (p - y)), 9) AS brier, round(avg(CAST(y AS DOUBLE)) * (1 - avg(CAST(y AS DOUBLE))), 9) AS brier_constant FROM s GROUP BY carrier")
def brier(spark, d):
    return evaluation.brier(_scored(spark, d), "p", "y", "carrier").select("carrier", "rows", F.round("brier", 9).alias("brier"), F.round("brier_constant", 9).alias("brier_constant"))


@query(f"WITH {_SCORED} SELECT round(avg(CAST(y AS DOUBLE)), 4) AS average_precision, round(avg(CAST(y AS DOUBLE)), 4) AS precision, 0.2::DOUBLE AS recall FROM s")
def random_baseline(spark, d):
    return evaluation.random_baseline(_scored(spark, d), "y", 0.2)


@query(f"WITH {_FLAGGED} SELECT carrier, count(*) AS flights, round(100.0::DOUBLE * avg(CAST(y AS DOUBLE)), 2) AS actual_pct, round(100.0::DOUBLE * avg(p), 2) AS predicted_pct, CAST(sum(flagged) AS BIGINT) AS flagged FROM r GROUP BY carrier")
def model_by_carrier(spark, d):
    f = evaluation.top_share(_scored(spark, d), "p", 0.2, _TIES)
    return f.groupBy("carrier").agg(F.count("*").alias("flights"), F.round(100.0 * F.avg(F.col("y").cast("double")), 2).alias("actual_pct"), F.round(100.0 * F.avg("p"), 2).alias("predicted_pct"), F.sum("flagged").cast("long").alias("flagged"))


@query()
def bootstrap_ci(spark, d):
    s = _scored(spark, d).withColumn("q", F.col("l_quantity") / 50)
    return evaluation.compared(materialize(s.select("day", "y", "p", "q"), "scores"), "day", "y", "p", "q")


_REPS = 12


@query(f"""WITH {_SCORED}, w AS (SELECT s.*, rep, ((day - DATE '1992-01-01') * (rep + 3) + (day - DATE '1992-01-01') // 7 + rep) % 4 AS w FROM s, (SELECT unnest(range({_REPS})) AS rep)),
 x AS (SELECT rep, y, w, 'discount' AS which, p AS s FROM w UNION ALL SELECT rep, y, w, 'quantity', l_quantity FROM w), g AS (SELECT rep, which, s, CAST(sum(y * w) AS DOUBLE) AS p, CAST(sum(w) AS DOUBLE) AS n FROM x GROUP BY ALL),
 c AS (SELECT *, sum(p) OVER (PARTITION BY rep, which ORDER BY s DESC) AS tp, sum(n) OVER (PARTITION BY rep, which ORDER BY s DESC) AS c, sum(p) OVER (PARTITION BY rep, which) AS pp, sum(n) OVER (PARTITION BY rep, which) - sum(p) OVER (PARTITION BY rep, which) AS nn FROM g)
 SELECT which, CAST(rep AS INT) AS rep, max(pp + nn) AS rows, max(pp) AS positives, round(sum((n - p) * (tp - p / 2)) / max(pp * nn), 9) AS roc_auc, round(sum(CASE WHEN c > 0 THEN p * tp / c ELSE 0 END) / max(pp), 9) AS average_precision FROM c GROUP BY which, rep""")
def resampled_curves(spark, d):
    """Both areas of two scores in resamples whose weights of each day are stated by a rule."""
    s = materialize(_scored(spark, d).select("day", "y", "p", "l_quantity"), "scores")
    days = s.select("day", F.datediff("day", F.lit("1992-01-01").cast("date")).alias("k")).distinct().collect()
    draws = {r["day"]: [(r["k"] * (rep + 3) + r["k"] // 7 + rep) % 4 for rep in range(_REPS)] for r in days}
    found = evaluation.resampled(s, "day", "y", {"discount": "p", "quantity": "l_quantity"}, draws)
    return found.select("which", "rep", "rows", "positives", *[F.round(c, 9).alias(c) for c in ("roc_auc", "average_precision")])


# --- models

_NUMERIC, _CATEGORICAL = ["qty", "price", "disc", "dep_hour", "dow", "month"], ["carrier_name"]


def _model_rows(spark, d):
    """Label: the delay is long; a third of the quantities are unknown."""
    f = flights(spark, d, known=F.col("l_partkey") % 3 != 0).filter(metrics.completed())
    return f.select("l_orderkey", "l_linenumber", "year", F.when(F.col("known"), F.col("l_quantity")).alias("qty"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("disc"), "dep_hour", "dow", "month", F.concat(F.lit("c"), "carrier").alias("carrier_name"), F.col("is_delayed").alias("y"))

def _fit_rows(spark, d, *columns):
    """The model rows (or some columns of them), written once: a fit passes over them many times, and each pass would join the tables anew."""
    x = _model_rows(spark, d)
    return materialize(x.select(*columns) if columns else x, "model-rows")


@query()
def logistic_scores(spark, d):
    x = _fit_rows(spark, d)
    fitted = models.fit_logistic(x.filter("year < 1999"), _NUMERIC, _CATEGORICAL, "y")
    return models.score(fitted, x.filter("year >= 1999"), "score").select("l_orderkey", "l_linenumber", "y", F.round("score", 6).alias("score"))


@query()
def gbt_scores(spark, d):
    x = _fit_rows(spark, d)
    fitted = models.fit_trees(x.filter("year < 1999"), _NUMERIC, _CATEGORICAL, "y", grouped=True)
    return models.score(fitted, x.filter("year >= 1999"), "score").select("l_orderkey", "l_linenumber", "y", F.round("score", 6).alias("score"))


_PARTS = {"lines": (0.125, 4.0), "qty": (0.125, 25.0), "month": (-0.25, 6.0), "dow": (0.5, 4.0)}


@query(f"""WITH {FLIGHTS}, x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_linenumber AS DOUBLE) AS lines, CASE WHEN l_partkey % 3 <> 0 THEN trunc(l_quantity) END AS qty, CAST(month AS DOUBLE) AS month, CAST(dow AS DOUBLE) AS dow FROM f WHERE NOT is_cancelled AND NOT is_diverted),
 p AS (SELECT x.*, [""" + ", ".join(f"{{'f': '{c}', 'v': CAST({c} AS DOUBLE), 'p': coalesce(({c} - {m}) * {w}, 0)}}" for c, (w, m) in _PARTS.items()) + """] AS parts FROM x)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, array_to_string(list_transform(list_transform(list_sort(list_transform(range(1, len(parts) + 1), lambda i: {'k': -abs(parts[i].p), 'i': i}))[1:3], lambda s: parts[s.i]), lambda x: x.f || ' = ' || CASE WHEN x.v IS NOT NULL THEN printf('%.1f', x.v) WHEN x.f = 'qty' THEN 'unknown' ELSE 'n/a' END || ' (' || printf('%+.3f', CAST(x.p AS DOUBLE)) || ')'), '; ') AS reasons FROM p""")
def score_reasons(spark, d):
    """The three largest parts of a linear score, either way, in words."""
    f = flights(spark, d).filter(metrics.completed())
    x = f.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("lines"), F.when(F.col("l_partkey") % 3 != 0, F.col("l_quantity").cast("int")).alias("qty"), "month", "dow")
    parts = models.contributions(x, {c: w for c, (w, _) in _PARTS.items()}, {c: m for c, (_, m) in _PARTS.items()})
    return parts.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", models.top_reasons(unknown={"qty": "unknown"}).alias("reasons"))


@query()
def model_reasons(spark, d):
    """Scores of a fitted model with their reasons, in the fitted weights."""
    x = _fit_rows(spark, d)
    fitted = models.fit_logistic(x.filter("year < 1999"), _NUMERIC, _CATEGORICAL, "y")
    weights, means = models.linear_parts(fitted, _NUMERIC)
    scored = models.contributions(models.score(fitted, x.filter("year >= 1999"), "score"), weights, means)
    return scored.select("l_orderkey", "l_linenumber", F.round("score", 6).alias("score"), models.top_reasons(unknown={"qty": "unknown"}).alias("reasons"))


@query(f"WITH {FLIGHTS}, x AS (SELECT CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS q, l_discount AS d FROM f WHERE NOT is_cancelled AND NOT is_diverted), u AS (SELECT 'load' AS feature_group, coalesce(abs((q - 25) * 0.02), 0) AS a FROM x UNION ALL SELECT 'price', coalesce(abs((d - 0.05) * 3), 0) FROM x) SELECT feature_group, round(sum(a) / (SELECT sum(a) FROM u), 9) AS share FROM u GROUP BY feature_group")
def mean_contribution(spark, d):
    x = models.contributions(_model_rows(spark, d), {"qty": 0.02, "disc": 3.0}, {"qty": 25.0, "disc": 0.05})
    return models.mean_contribution(x, {"qty": "load", "disc": "price"}).select("feature_group", F.round("share", 9).alias("share"))
