"""Readers: zipped CSV text, airports, hourly weather JSON, zones, carriers, caches."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


def csv_in(archive: zipfile.ZipFile, path: str) -> str:
    """The name of the single CSV in a zip; errors say what is wrong with it."""
    names = [n for n in archive.namelist() if n.lower().endswith(".csv")]
    if len(names) != 1:
        raise ValueError(f"{path} holds {len(names)} CSV files, not one")
    return names[0]


#: Rows of a zipped CSV that are parsed at a time, and characters of one field at most.
ROWS, FIELD = 20_000, 1 << 24


def read_zipped_csv(spark: SparkSession, paths: str | list[str], columns: dict[str, str], *, rows: int = ROWS, loaded_at=None) -> DataFrame:
    """Chosen columns of zips with one CSV each, as ``read_text_csv`` gives them.

    A zip cannot be split, so a task reads whole ones, as Spark's binary files (of up to 2 GB compressed); their text is inflated
    and parsed as a stream, ``rows`` at a time, with quoted line ends anywhere, and is never whole in memory nor on disk. Rows that
    are shorter than the header count as blank there. What is wrong with a zip, or columns that it lacks, fails the task.
    """
    names = [*columns.values(), "source_file"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(FIELD)
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                raw = pa.BufferReader(content.as_buffer())
                if not zipfile.is_zipfile(raw):
                    raise ValueError(f"{path} is not a zip file")
                with zipfile.ZipFile(raw) as archive, archive.open(member := csv_in(archive, path)) as stream:
                    found = csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""))
                    header = next(found, [])
                    if lost := [c for c in columns if c not in header]:
                        raise ValueError(f"columns not in {path}: {lost}")
                    at = [header.index(c) for c in columns]
                    while some := list(islice(found, rows)):
                        some = [r for r in some if r]  # blank lines
                        picked = [pa.array([r[i] if i < len(r) else "" for r in some], pa.string()) for i in at]
                        yield pa.RecordBatch.from_arrays([*picked, pa.array([member.rsplit("/", 1)[-1]] * len(some), pa.string())], names)

    found = spark.read.format("binaryFile").load(paths).select("path", "content")
    when = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return found.mapInArrow(run, T.StructType([T.StructField(c, T.StringType()) for c in names])).withColumn("loaded_at", when)


def read_text_csv(spark: SparkSession, paths: str | list[str], columns: dict[str, str], *, loaded_at=None) -> DataFrame:
    """Chosen columns of a CSV with a header, all as text, renamed; blanks stay blanks.

    ``columns``: name in the file to name here; they are looked up in the header, so other columns
    are neither parsed into rows nor kept. Adds source_file and loaded_at.
    """
    raw = spark.read.option("header", True).option("nullValue", "\u0000").option("emptyValue", "").csv(paths)
    if lost := [c for c in columns if c not in raw.columns]:
        raise ValueError(f"columns not in the file: {lost}")
    picked = [F.coalesce(F.col(f"`{a}`"), F.lit("")).alias(b) for a, b in columns.items()]
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    when = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return raw.select(*picked, name.alias("source_file"), when.alias("loaded_at"))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to a schema's types, blanks to null; columns outside the schema stay. Malformed values raise, as a bulk load would."""
    kinds = {f.name: f.dataType for f in schema}
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return df.select(*[(F.col(c) if c not in kinds or isinstance(kinds[c], T.StringType) or not isinstance(df.schema[c].dataType, T.StringType) else blank(c).cast(kinds[c]).alias(c)) for c in df.columns])


def read_flights(spark: SparkSession, paths: str | list[str], columns: dict[str, str], *, zipped: bool = False, loaded_at=None) -> DataFrame:
    return typed((read_zipped_csv if zipped else read_text_csv)(spark, paths, columns, loaded_at=loaded_at), schemas.FLIGHTS)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airports with a three-character code; ``type`` is renamed."""
    raw = spark.read.option("header", True).csv(path)
    kept = raw.filter(F.col("iata_code").rlike(f"^{schemas.IATA}$"))
    return typed(kept.withColumnRenamed("type", "airport_type").select(*[f.name for f in schemas.AIRPORTS]), schemas.AIRPORTS)


def airport_rank(airports: DataFrame) -> list:
    """Order in which rows of one code are preferred: the home country, then larger airports, then the identifier."""
    size = F.when(F.col("airport_type") == "large_airport", 1).when(F.col("airport_type") == "medium_airport", 2).when(F.col("airport_type") == "small_airport", 3).otherwise(4)
    return [F.desc_nulls_first(F.col("iso_country") == "US"), size.asc(), F.asc_nulls_last("ident")]


def read_hourly(spark: SparkSession, paths: str | list[str], *, loaded_at=None) -> DataFrame:
    """Parallel hourly arrays of each place to one row for each hour."""
    raw = spark.read.schema(schemas.HOURLY_JSON).option("multiLine", True).json(paths)
    zipped = F.arrays_zip(*[F.col(f"hourly.{c}").alias(c) for c in ("time", *schemas.HOURLY)])
    rows = raw.select("airport_code", F.explode(zipped).alias("h"))
    when = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return rows.select("airport_code", F.col("h.time").cast("timestamp_ntz").alias("ts_utc"), *[F.col(f"h.{a}").cast("double").alias(b) for a, b in schemas.HOURLY.items()], when.alias("loaded_at"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path).select(F.col("airport_code"), F.col("timezone"))


def seed(spark: SparkSession, rows: Iterable[tuple[str, str]], columns: tuple[str, str] = ("carrier_code", "carrier_name")) -> DataFrame:
    """A small versioned table."""
    return spark.createDataFrame(list(rows), T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def missing_from_cache(wanted: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """What has yet to be fetched: wanted keys that the cache lacks."""
    return wanted.select(key).distinct().join(cached.select(key).distinct(), key, "left_anti")


def month_range(first_day: str) -> tuple[str, str]:
    """First day of the month less one, and first day of the next month: a month in any zone's UTC days."""
    import datetime as dt

    first = dt.date.fromisoformat(first_day).replace(day=1)
    after = (first + dt.timedelta(days=32)).replace(day=1)
    return str(first - dt.timedelta(days=1)), str(after)


def last_months(df: DataFrame, day: str, n: int = 4) -> list[tuple[int, int]]:
    """The last n (year, month) pairs, oldest first: n rows reach the driver."""
    rows = df.filter(F.col(day).isNotNull()).select(F.year(day).alias("y"), F.month(day).alias("m")).distinct().orderBy(F.desc("y"), F.desc("m")).limit(n).collect()
    return [(r["y"], r["m"]) for r in rows][::-1]
