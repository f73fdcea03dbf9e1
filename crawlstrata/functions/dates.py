"""Capture dates as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 14-digit capture date.
DATE14 = "yyyyMMddHHmmss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capture_ts(date) -> Column:
    """Time of a 14-digit (24-hour, UTC) or ISO date string; null if it is neither."""
    date = _col(date)
    utc = F.concat(F.when(date.rlike("^[0-9]{14}$"), date), F.lit("+0000"))
    digits = F.try_to_timestamp(utc, F.lit(f"{DATE14}xx"))
    iso = F.when(date.contains("-"), F.trim(date))
    zoned = (
        F.when(iso.rlike(r"^[0-9]+-[0-9]+-[0-9]+$"), F.concat(iso, F.lit("T00:00:00Z")))
        .when(iso.rlike(r"[ T][0-9]+(:[0-9]+){1,2}([.][0-9]*)?$"), F.concat(iso, F.lit("Z")))
        .otherwise(iso)
    )
    return F.coalesce(digits, F.try_to_timestamp(zoned))


def date14(ts) -> Column:
    """14-digit UTC date string of a time, whatever the session's time zone."""
    seconds = F.unix_seconds(_col(ts))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    part = lambda every, size: F.lpad(F.pmod(F.floor(seconds / every), F.lit(size)).cast("string"), 2, "0")
    return F.concat(F.date_format(day, "yyyyMMdd"), part(3600, 24), part(60, 60), part(1, 60))


def capture_day(date) -> Column:
    """First eight characters of a date string; null if it is shorter."""
    date = _col(date)
    return F.when(F.length(date) >= 8, F.substring(date, 1, 8))


def date_unit(date, unit) -> Column:
    """Year, month or day of a date string; any other unit gives the whole; null if it is too short."""
    date = _col(date)
    unit = F.lit(unit) if isinstance(unit, str) else unit
    part = (
        F.when(unit == "year", F.substring(date, 1, 4))
        .when(unit == "month", F.substring(date, 5, 2))
        .when(unit == "day", F.substring(date, 7, 2))
        .otherwise(date)
    )
    return F.when((F.length(date) >= 8) & unit.isNotNull(), part)
