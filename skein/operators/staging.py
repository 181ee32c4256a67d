"""Landing rows to typed, deduplicated legs on one UTC time line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .metrics import reason, status
from .rows import keep_latest, rotation, volumes

#: The natural key and the causes of delay.
KEY = ["flight_date", "reporting_airline", "flight_number", "origin", "crs_dep_time"]
CAUSES = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]


def stage(raw: DataFrame) -> DataFrame:
    """One typed row for each scheduled flight; the latest load wins."""
    once = keep_latest(raw, KEY, "loaded_at", "source_file")
    dep, arr = S.clock_text("crs_dep_time"), S.clock_text("crs_arr_time")
    return once.select(
        S.surrogate_key(*KEY).alias("flight_key"), "flight_date", F.col("year").cast("int").alias("flight_year"), F.col("month").cast("int").alias("flight_month"),
        F.col("day_of_month").cast("int").alias("day_of_month"), F.col("day_of_week").cast("int").alias("day_of_week"), F.col("reporting_airline").alias("carrier_code"),
        S.blank_to_null("tail_number").alias("tail_number"), "flight_number", "origin", "dest", S.route("origin", "dest").alias("route"),
        dep.alias("crs_dep_time"), S.clock_hour(dep).alias("dep_hour"), S.clock_minutes(dep).alias("dep_minute"), arr.alias("crs_arr_time"), S.clock_hour(arr).alias("arr_hour"), S.clock_minutes(arr).alias("arr_minute"),
        S.whole("crs_elapsed_time").alias("elapsed_minutes"), S.whole("distance").alias("distance_miles"), S.flag("cancelled").alias("is_cancelled"), S.flag("diverted").alias("is_diverted"),
        S.blank_to_null("cancellation_code").alias("cancellation_code"), reason("cancellation_code").alias("cancellation_reason"),
        S.whole("dep_delay").alias("dep_delay"), S.whole("arr_delay").alias("arr_delay"), S.whole("arr_del15").alias("is_delayed"),
        *[S.whole(F.coalesce(F.col(c), F.lit(0))).alias(f"{c}_minutes") for c in CAUSES], "source_file",
    )


#: The columns of the fact table, and those of the model's rows, which hold nothing of the time after departure.
FACT = [
    "flight_key", "flight_date", "flight_year", "flight_month", "day_of_week", "carrier_code", "origin", "dest", "route", "flight_number", "tail_number", "dep_hour", "arr_hour", "distance_miles", "elapsed_minutes", "status", "is_cancelled", "is_diverted", "cancellation_reason", "is_delayed",
    "dep_delay", "arr_delay", *[f"{c}_minutes" for c in CAUSES],
]
MODEL_ROWS = [
    "flight_key", "flight_date", "flight_year", "flight_month", "day_of_month", "day_of_week", "carrier_code", "flight_number", "origin", "dest", "route", "dep_hour", "arr_hour", "dep_minute", "elapsed_minutes", "distance_miles", "leg_of_day", "legs_today", "turnaround",
    "origin_in_hour", "dest_in_hour", "origin_in_day", "is_delayed",
]


def fact(enriched: DataFrame) -> DataFrame:
    """One narrow row for each scheduled flight, cancelled and diverted ones too."""
    return enriched.select(*FACT)


def model_rows(enriched: DataFrame) -> DataFrame:
    """Completed flights with what was known before departure, and the label."""
    return enriched.filter(~F.col("is_cancelled") & ~F.col("is_diverted")).select(*MODEL_ROWS)


def enrich(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Status, the UTC time line, rotation and scheduled volumes.

    Arrival in UTC is departure plus duration; the local arrival clock is only its stand-in where
    the duration is unknown. Zones are looked up twice, once for each end.
    """
    z = lambda role: zones.select(F.col("airport_code").alias(f"__{role}"), F.col("timezone").alias(f"__{role}_zone"))
    d = staged.join(z("o"), staged["origin"] == F.col("__o"), "left").join(z("d"), staged["dest"] == F.col("__d"), "left")
    d = d.withColumn("arr_date", S.arrival_day("flight_date", "dep_minute", "elapsed_minutes", "arr_minute"))
    d = d.withColumn("sched_dep_utc", S.to_utc(S.local_timestamp("flight_date", "dep_minute"), "__o_zone")).withColumn("sched_arr_local_utc", S.to_utc(S.local_timestamp("arr_date", "arr_minute"), "__d_zone"))
    d = d.withColumn("sched_arr_utc", F.coalesce(F.col("sched_dep_utc") + S.minutes("elapsed_minutes"), F.col("sched_arr_local_utc")))
    d = d.withColumns({"actual_dep_utc": F.col("sched_dep_utc") + S.minutes("dep_delay"), "actual_arr_utc": F.col("sched_arr_utc") + S.minutes("arr_delay"), "cutoff_utc": F.col("sched_dep_utc") - S.minutes(F.lit(120)), "status": status()})
    d = rotation(d, "tail_number", "flight_date", "dep_minute", "arr_minute", "flight_key")
    d = volumes(d, origin_in_hour=["origin", "flight_date", "dep_hour"], dest_in_hour=["dest", "arr_date", "arr_hour"], origin_in_day=["origin", "flight_date"])
    return d.drop("__o", "__o_zone", "__d", "__d_zone")


def legs(enriched: DataFrame) -> DataFrame:
    """The event table of operators.features: keys, ends and whole minutes."""
    m = lambda c: S.epoch_minute(c)
    return enriched.select(
        F.col("flight_key").alias("key"), F.col("tail_number").alias("vehicle"), F.col("carrier_code").alias("carrier"), "origin", "dest", m("sched_dep_utc").alias("sched_dep"), m("sched_arr_utc").alias("sched_arr"),
        m("actual_dep_utc").alias("actual_dep"), m("actual_arr_utc").alias("actual_arr"), "dep_delay", "arr_delay", (~F.col("is_cancelled") & ~F.col("is_diverted")).alias("completed"),
    )
