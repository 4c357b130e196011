"""Persian (Jalali) calendar as column arithmetic.

The calendar repeats every 33 years with 8 leap years, so the days before a year are
``floor((12053 * year + 21) / 33)`` and a year is leap when ``(8 * year + 29) mod 33 < 8``.
Every expression names its inputs as seldom as possible: it stays small enough for code
generation even when Spark moves it into a filter.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.text import ascii_digits, plain_number, strip

_CYCLE_YEARS = 33
_CYCLE_DAYS = 33 * 365 + 8
_MAX_YEAR = 9377
# 979/01/01 is this day; 357572 days lie before that year in the formula above.
_ANCHOR = datetime.date(1600, 3, 20)
_ANCHOR_DAYS = 357572
_MONTH_LENGTHS = [31] * 6 + [30] * 5 + [29]
_MONTH_STARTS = [sum(_MONTH_LENGTHS[:i]) for i in range(12)]
_CLOCK = r" \d{1,2}:\d{1,2}:\d{1,2}$"


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _per_month(values: list[int], month: Column) -> Column:
    """Value of a month; null outside 1..12."""
    return F.get(F.array(*[F.lit(v) for v in values]), month - 1)


def _days_before(year: Column) -> Column:
    return _div(year * _CYCLE_DAYS + 21, _CYCLE_YEARS)


def is_leap(year: Column) -> Column:
    return F.pmod(year * 8 + 29, F.lit(_CYCLE_YEARS)) < 8


def is_valid(year: Column, month: Column, day: Column) -> Column:
    leap_day = ((month == 12) & is_leap(year)).cast("int")
    length = _per_month(_MONTH_LENGTHS, month) + leap_day
    return year.between(1, _MAX_YEAR) & (day >= 1) & (day <= length)


def from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date of a valid Jalali year, month and day."""
    days = _days_before(year) + _per_month(_MONTH_STARTS, month) + day - (_ANCHOR_DAYS + 1)
    return F.date_add(F.lit(_ANCHOR), days.cast("int"))


def to_date(c: Column, strict: bool = True) -> Column:
    """``y/m/d`` text, padded or not, in ASCII or Persian digits -> date."""
    parts = F.split(plain_number(c), "/")
    # Small integers: absurd values become null and no arithmetic below can overflow.
    year, month, day = (F.get(parts, F.lit(i)).try_cast("smallint") for i in range(3))
    valid = (F.size(parts) == 3) & is_valid(year, month, day)
    parsed = F.when(valid, from_parts(year, month, day))
    if strict:
        message = F.concat(F.lit("not a Jalali date: "), c)
        return parsed.when(c.isNotNull(), F.raise_error(message).cast("date"))
    return parsed


def to_timestamp(c: Column, strict: bool = True) -> Column:
    """``y/m/d H:M:S`` -> local timestamp; a date alone means midnight."""
    text = strip(ascii_digits(c))
    date = to_date(F.substring_index(text, " ", 1), strict=False).cast("string")
    clock = F.regexp_substr(text, F.lit(_CLOCK))
    rest = F.when(F.instr(text, " ") == 0, F.lit(" 00:00:00")).otherwise(clock)
    stamped = F.concat(date, rest).try_cast("timestamp_ntz")
    if strict:
        message = F.concat(F.lit("not a Jalali timestamp: "), c)
        return F.coalesce(
            stamped, F.when(c.isNotNull(), F.raise_error(message).cast("timestamp_ntz"))
        )
    return stamped


def from_date(date: Column, padded: bool = True) -> Column:
    """Date -> ``y/m/d`` text, with two-digit month and day when ``padded``."""
    days = F.date_diff(date, F.lit(_ANCHOR)) + _ANCHOR_DAYS
    year = _div(days * _CYCLE_YEARS + 11, _CYCLE_DAYS)
    in_year = days - _days_before(year)
    month0 = F.greatest(_div(in_year, 31), _div(in_year - 6, 30))
    day = in_year - month0 * 30 - F.least(month0, F.lit(6)) + 1
    parts = [year, month0 + 1, day]
    if not padded:
        return F.concat_ws("/", *[p.cast("string") for p in parts])
    widths = [4, 2, 2]
    return F.concat_ws("/", *[F.lpad(p.cast("string"), w, "0") for p, w in zip(parts, widths)])
