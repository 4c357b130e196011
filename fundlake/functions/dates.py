"""Gregorian date and time columns as the vendors write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEHRAN = "Asia/Tehran"


def us_date(c: Column, strict: bool = True) -> Column:
    """``month/day/year`` -> date; month and day may have one or two digits."""
    return F.to_date(c, "M/d/yyyy") if strict else F.try_to_date(c, "M/d/yyyy")


def instant(c: Column, strict: bool = True) -> Column:
    """ISO text with an offset -> instant."""
    return F.to_timestamp(c) if strict else F.try_to_timestamp(c)


def tehran_date(ts: Column) -> Column:
    """Calendar day in Tehran of an instant; the session runs in UTC."""
    return F.to_date(F.from_utc_timestamp(ts, TEHRAN))


def wall_clock(c: Column, strict: bool = True) -> Column:
    """ISO text with the offset dropped, so the local wall clock stays."""
    local = F.regexp_replace(F.trim(c), r"(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$", "")
    return local.cast("timestamp_ntz") if strict else local.try_cast("timestamp_ntz")
