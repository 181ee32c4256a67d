"""The driver tables as scheduled legs and events, in Spark and in SQL.

An order line is a leg: its supplier's nation is carrier and origin, its customer's nation the
destination, the days from order to shipping the delay. Events are legs of their users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

ZONES = ["America/New_York", "America/Los_Angeles", "Europe/Paris", "Asia/Tokyo", "UTC"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str, **early: Column) -> DataFrame:
    """Lines with their ends, flags, delay and label. Columns not used later are pruned at the scans.

    Lines meet suppliers, and orders meet customers, before the two meet: lines are shuffled by one key only, narrowed to what is used later.
    ``early``: further columns, found from a line's own before it is shuffled.
    """
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").withColumns({"shipped": F.col("l_shipdate").cast("date"), **early}).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    ends = t("orders").withColumn("day", F.col("o_orderdate").cast("date")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = lines.join(ends, F.col("l_orderkey") == F.col("o_orderkey"))
    day = F.col("day")
    delay = F.datediff("shipped", day)
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", F.col("s_nationkey").alias("carrier"), F.col("s_nationkey").alias("origin"), F.col("c_nationkey").alias("dest"),
        S.route("s_nationkey", "c_nationkey").alias("route"), day, F.year(day).alias("year"), F.month(day).alias("month"), S.iso_weekday(day).alias("dow"), F.pmod(F.col("l_quantity").cast("int"), F.lit(24)).alias("dep_hour"),
        delay.alias("delay"), (F.col("l_returnflag") == "R").alias("is_cancelled"), ((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")).alias("is_diverted"), (delay >= 15).cast("int").alias("is_delayed"), *early,
    )


FLIGHTS = """f AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, s_nationkey AS carrier, s_nationkey AS origin, c_nationkey AS dest,
    CAST(s_nationkey AS VARCHAR) || '-' || CAST(c_nationkey AS VARCHAR) AS route, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(isodow(o_orderdate) AS INT) AS dow,
    CAST(trunc(l_quantity) AS INT) % 24 AS dep_hour, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INT) AS delay, l_returnflag = 'R' AS is_cancelled, (l_linestatus = 'O' AND l_returnflag = 'N') AS is_diverted,
    CASE WHEN CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) >= 15 THEN 1 ELSE 0 END AS is_delayed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey)"""

METRICS = """count(*) AS scheduled_flights, CAST(sum(CASE WHEN is_cancelled THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_flights, CAST(sum(CASE WHEN is_diverted THEN 1 ELSE 0 END) AS BIGINT) AS diverted_flights,
  CAST(sum(CASE WHEN NOT is_cancelled AND NOT is_diverted THEN 1 ELSE 0 END) AS BIGINT) AS completed_flights, CAST(sum(CASE WHEN NOT is_cancelled AND NOT is_diverted THEN is_delayed ELSE 0 END) AS BIGINT) AS delayed_flights,
  round(avg(CAST(CASE WHEN is_cancelled THEN 1 ELSE 0 END AS DOUBLE)), 4) AS cancellation_rate, round(avg(CAST(CASE WHEN NOT is_cancelled AND NOT is_diverted THEN is_delayed END AS DOUBLE)), 4) AS delay_rate,
  round(1 - avg(CAST(CASE WHEN NOT is_cancelled AND NOT is_diverted THEN is_delayed END AS DOUBLE)), 4) AS on_time_pct, round(avg(CAST(CASE WHEN NOT is_cancelled AND NOT is_diverted THEN delay END AS DOUBLE)), 2) AS avg_delay"""


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with whole minutes, day, clock minute and an integer measure."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "ts", "value", S.epoch_minute("ts").alias("m"), F.col("ts").cast("date").alias("day"), (F.hour("ts") * 60 + F.minute("ts")).alias("clock"), F.floor("value").cast("int").alias("n"))


TIMELINE = """e AS (SELECT event_id, user_id, event_type, ts, value, CAST(floor(epoch(ts) / 60) AS BIGINT) AS m, CAST(ts AS DATE) AS day, CAST(hour(ts) * 60 + minute(ts) AS INT) AS clock, CAST(floor(value) AS INT) AS n FROM events)"""


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as legs for the feature builder: the user is the vehicle, delays follow from the measure, clicks never leave."""
    e = timeline(spark, sf_dir)
    gone = F.col("event_type") != "click"
    dep, arr = F.when(gone, F.pmod("n", F.lit(90)) - 20), F.when(gone, F.pmod("n", F.lit(70)) - 10)
    start, length = F.col("m"), F.lit(60) + F.pmod("event_id", F.lit(120))
    return e.select(
        F.col("event_id").alias("key"), F.col("user_id").alias("vehicle"), F.pmod("user_id", F.lit(7)).alias("carrier"), F.pmod("user_id", F.lit(10)).alias("origin"), F.pmod("event_id", F.lit(10)).alias("dest"),
        start.alias("sched_dep"), (start + length).alias("sched_arr"), (start + dep).alias("actual_dep"), (start + length + arr).alias("actual_arr"), dep.alias("dep_delay"), arr.alias("arr_delay"), (F.col("event_type") == "purchase").alias("completed"),
    )


LEGS = (
    TIMELINE
    + """, g AS (SELECT event_id AS key, user_id AS vehicle, user_id % 7 AS carrier, user_id % 10 AS origin, event_id % 10 AS dest, m AS sched_dep, m + 60 + event_id % 120 AS sched_arr,
    CASE WHEN event_type <> 'click' THEN n % 90 - 20 END AS dep_delay, CASE WHEN event_type <> 'click' THEN n % 70 - 10 END AS arr_delay, event_type = 'purchase' AS completed, m - 120 AS cutoff FROM e),
  l AS (SELECT *, sched_dep + dep_delay AS actual_dep, sched_arr + arr_delay AS actual_arr FROM g)"""
)


#: The hourly values made of an event's measure n, in Spark and DuckDB alike.
WEATHER = {"temp": "n % 40 - 10", "wet": "n", "snow": "CASE WHEN event_id % 5 = 0 THEN n % 7 END", "wind": "n % 90", "gust": "n % 130", "cloud": "CASE WHEN event_id % 3 > 0 THEN n % 101 END"}


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rows of ten places with gaps and repeats, from the events."""
    e = timeline(spark, sf_dir)
    return e.select(F.pmod("user_id", F.lit(10)).alias("place"), (F.floor(F.col("m") / 60) * 60).alias("hour_minute"), F.col("event_id").alias("loaded"), *[F.expr(v).alias(k) for k, v in WEATHER.items()])


HOURLY = "h AS (SELECT user_id % 10 AS place, CAST(floor(m / 60) * 60 AS BIGINT) AS hour_minute, event_id AS loaded, " + ", ".join(f"{v} AS {k}" for k, v in WEATHER.items()) + " FROM e)"
