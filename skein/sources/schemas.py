"""Schemas of the landing tables. Constraints are checks here (see operators.quality), as Spark enforces none."""

from __future__ import annotations

from pyspark.sql import types as T

IATA = "[A-Z0-9]{3}"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_n, _s, _i = T.DecimalType(10, 2), T.StringType(), T.ShortType()

#: Columns and types of the landing tables.
FLIGHTS = _struct(
    flight_date=T.DateType(), year=_i, month=_i, day_of_month=_i, day_of_week=_i, reporting_airline=_s, tail_number=_s, flight_number=_s, origin=_s, dest=_s,
    crs_dep_time=_s, dep_time=_s, dep_delay=_n, crs_arr_time=_s, arr_time=_s, arr_delay=_n, arr_del15=_n, cancelled=_n, cancellation_code=_s, diverted=_n,
    crs_elapsed_time=_n, distance=_n, carrier_delay=_n, weather_delay=_n, nas_delay=_n, security_delay=_n, late_aircraft_delay=_n,
)
AIRPORTS = _struct(iata_code=_s, ident=_s, airport_type=_s, name=_s, latitude_deg=T.DoubleType(), longitude_deg=T.DoubleType(), iso_country=_s, iso_region=_s, municipality=_s)
#: Name in the weather files to name here.
HOURLY = {
    "temperature_2m": "temperature_c", "precipitation": "precipitation_mm", "snowfall": "snowfall_cm",
    "wind_speed_10m": "wind_speed_kmh", "wind_gusts_10m": "wind_gusts_kmh", "cloud_cover_low": "cloud_cover_low_pct",
}
HOURLY_JSON = _struct(airport_code=_s, hourly=T.StructType([T.StructField("time", T.ArrayType(_s))] + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in HOURLY]))
