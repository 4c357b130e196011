"""Text and number columns: Persian digits, separators, Unicode whitespace, URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ASCII_DIGITS = "0123456789"

# The characters of the Unicode White_Space property.
_WHITESPACE_POINTS = [
    *range(0x09, 0x0E),
    0x20,
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
]
WHITESPACE = "".join(map(chr, _WHITESPACE_POINTS))


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends (Spark's plain trim removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_text(c: Column, text: str) -> Column:
    """Null where the stripped value is exactly ``text``."""
    stripped = strip(c)
    return F.when(stripped != text, stripped)


def normalize_letters(c: Column) -> Column:
    """Arabic yeh and kaf become their Persian forms."""
    return F.translate(c, "يك", "یک")


def ascii_digits(c: Column) -> Column:
    """Persian and Arabic-Indic digits become ASCII digits."""
    return F.translate(c, PERSIAN_DIGITS + ARABIC_DIGITS, ASCII_DIGITS * 2)


def persian_digits(c: Column) -> Column:
    return F.translate(c, ASCII_DIGITS, PERSIAN_DIGITS)


def _cast(c: Column, to: str, strict: bool) -> Column:
    return c.cast(to) if strict else c.try_cast(to)


def plain_number(c: Column, spoilt: str = "", dropped: str = "") -> Column:
    """ASCII digits and ASCII spaces in one pass over the text.

    Casts to numbers ignore ASCII spaces at both ends, so this also strips Unicode
    whitespace. Characters of ``spoilt`` become question marks, those of ``dropped`` vanish.
    """
    source = PERSIAN_DIGITS + ARABIC_DIGITS + WHITESPACE + spoilt + dropped
    target = ASCII_DIGITS * 2 + " " * len(WHITESPACE) + "?" * len(spoilt)
    return F.translate(c, source, target)


def to_double(c: Column, strict: bool = True, blank_is_null: bool = False) -> Column:
    """Number text with Persian digits and comma separators -> double.

    ``blank_is_null`` accepts text of nothing but whitespace as a missing value. The JVM
    also reads '5d' and '5f' as numbers; the letters are spoilt, so that such text is bad
    like any other. Infinity by name is bad text too.
    """
    plain = plain_number(c, spoilt="dDfF", dropped=",")
    if strict and blank_is_null:
        return F.when(F.trim(plain) != "", plain.cast("double"))
    return _cast(plain, "double", strict)


def to_bigint(c: Column, strict: bool = True) -> Column:
    """Number text -> bigint, a fraction being cut off; exact for all 64-bit values."""
    plain = plain_number(c, dropped=",")
    through_decimal = _cast(_cast(plain, "decimal(38,10)", strict), "bigint", strict)
    return F.coalesce(plain.try_cast("bigint"), through_decimal)


def to_whole(c: Column, strict: bool = True) -> Column:
    """Integer text with separators -> bigint; a fraction is bad text."""
    return _cast(plain_number(c, dropped=","), "bigint", strict)


def after_first(c: Column, marker: str) -> Column:
    """Text behind the first ``marker``; empty when it does not occur."""
    at = F.instr(c, marker)
    return F.when(at > 0, F.substring(c, at + F.lit(len(marker)), F.length(c))).when(
        c.isNotNull(), F.lit("")
    )


def before_first(c: Column, marker: str) -> Column:
    """Text ahead of the first ``marker``; everything when it does not occur."""
    return F.substring_index(c, marker, 1)


def before_last(c: Column, marker: str) -> Column:
    """Text ahead of the last ``marker``; empty when it does not occur."""
    return F.regexp_extract(c, f"(?s)^(.*){re.escape(marker)}", 1)


def after_last(c: Column, marker: str) -> Column:
    """Text behind the last ``marker``; null when it does not occur."""
    return F.when(c.contains(marker), F.substring_index(c, marker, -1))


def url_domain(c: Column) -> Column:
    """The part between ``//`` and the next ``/``; null when there is none."""
    return F.nullif(F.regexp_extract(c, "//([^/]+)/", 1), F.lit(""))


def url_base(c: Column) -> Column:
    """``scheme://host/`` in lower case, without the port."""
    scheme = F.try_parse_url(c, F.lit("PROTOCOL"))
    host = F.try_parse_url(c, F.lit("HOST"))
    return F.lower(F.concat(scheme, F.lit("://"), host, F.lit("/")))


def has_fragment(c: Column) -> Column:
    return c.contains("#")
