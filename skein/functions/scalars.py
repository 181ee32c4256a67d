"""Scalar expressions of the schedule analytics. All are column functions: nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- keys and text


def surrogate_key(*columns: Column | str) -> Column:
    """md5 of the columns joined by ``|``; nulls are left out, as ``concat_ws`` does."""
    return F.md5(F.concat_ws("|", *[col(c).cast("string") for c in columns]))


def route(origin: Column | str, dest: Column | str) -> Column:
    """``origin-dest``; null if either is."""
    return F.concat(col(origin).cast("string"), F.lit("-"), col(dest).cast("string"))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def full_match(c: Column | str, pattern: str) -> Column:
    """Whether the whole text matches; null for null."""
    return col(c).rlike(f"^(?:{pattern})$")


def strip_suffix(c: Column | str, pattern: str) -> Column:
    """The text without a trailing match of ``pattern``, trimmed."""
    return F.trim(F.regexp_replace(col(c), rf"\s*(?:{pattern})$", ""))


def state_code(region: Column | str, country: str = "US") -> Column:
    """The region's code without its country's prefix; other countries' regions stay whole."""
    return F.replace(col(region), F.lit(f"{country}-"), F.lit(""))


def millions(c: Column | str) -> Column:
    return F.format_string("%.2fM", col(c).cast("double") / 1e6)


def percent(c: Column | str) -> Column:
    return F.format_string("%.1f%%", col(c).cast("double") * 100)


# --- numbers


def whole(c: Column | str) -> Column:
    """Rounded to an integer, halves away from zero (a plain cast would truncate)."""
    return F.round(col(c)).cast("int")


def flag(c: Column | str) -> Column:
    """0/1 number to boolean."""
    return col(c) == 1


def clip(c: Column | str, low: float, high: float) -> Column:
    """Between low and high; null stays null (``least`` and ``greatest`` would skip it)."""
    return F.when(col(c).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col(c))))


def not_negative(c: Column | str) -> Column:
    return F.when(col(c) >= 0, col(c))


def logit(p: Column | str, edge: float = 1e-6) -> Column:
    q = clip(p, edge, 1 - edge)
    return F.log(q / (1 - q))


def as_count(condition: Column) -> Column:
    """Sum of a condition; null counts as 0, no rows as 0."""
    return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("long")), F.lit(0).cast("long"))


# --- clock times (hhmm text) and time lines


def clock_text(c: Column | str) -> Column:
    """End-of-day midnight, written 2400, moved to 2359."""
    return F.when(col(c) == "2400", F.lit("2359")).otherwise(col(c))


def clock_hour(c: Column | str) -> Column:
    return F.substring(col(c), 1, 2).try_cast("int")


def clock_minutes(c: Column | str) -> Column:
    """Minutes from midnight of hhmm text; null for other text."""
    return clock_hour(c) * 60 + F.substring(col(c), 3, 2).try_cast("int")


def minutes(n: Column | str) -> Column:
    """An interval of n minutes; null for null."""
    return F.make_dt_interval(F.lit(0), F.lit(0), col(n).cast("int"), F.lit(0))


def local_timestamp(day: Column | str, minute: Column | str) -> Column:
    return col(day).cast("timestamp_ntz") + minutes(minute)


def to_utc(local: Column | str, zone: Column | str) -> Column:
    """A zone-less local time at a row's own zone, as zone-less UTC; null zone gives null."""
    return F.convert_timezone(col(zone), F.lit("UTC"), col(local))


def epoch_minute(ts: Column | str) -> Column:
    """Whole minutes since 1970 of a zone-less timestamp."""
    return F.timestamp_diff("MINUTE", F.lit("1970-01-01").cast("timestamp_ntz"), col(ts).cast("timestamp_ntz"))


def arrival_day(day: Column | str, departs: Column | str, elapsed: Column | str, arrives: Column | str) -> Column:
    """Day of arrival from minutes of day: whole days that departure plus duration lies after the arrival clock; 0 if unknown."""
    days = F.round((col(departs) + col(elapsed) - col(arrives)) / F.lit(1440.0)).cast("int")
    return F.date_add(col(day), F.coalesce(days, F.lit(0)))


def week_start(day: Column | str) -> Column:
    """The Sunday on or before the day."""
    return F.date_sub(F.date_trunc("week", F.date_add(col(day), 1)).cast("date"), 1)


def month_index(day: Column | str) -> Column:
    return F.year(col(day)) * 12 + F.month(col(day)) - 1


def month_label(day: Column | str) -> Column:
    return F.date_format(col(day), "MMM yyyy")


def month_name(month: Column | str) -> Column:
    return F.date_format(F.make_date(F.lit(2000), col(month), F.lit(1)), "MMM")


def weekday_name(number: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.element_at(F.array(*[F.lit(x) for x in ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")]), col(number))


def iso_weekday(day: Column | str) -> Column:
    return F.weekday(col(day)) + 1
