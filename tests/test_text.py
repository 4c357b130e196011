import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundlake.functions import dates, text


def one(spark, value, function):
    rows = spark.createDataFrame([(value,)], "c string")
    return rows.select(function(F.col("c")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("۱۲,۴۲۰", 12420.0),
        ("\n ۱۱,۲۵۰.۷۵\t", 11250.75),
        (" 12.75 ", 12.75),
        ("۱,۸۱۶,۷۱۱,۶۹۳,۵۶۹,۰۷۰,۰۰۰", 1.81671169356907e18),
        ("-۳", -3.0),
        ("1e3", 1000.0),
        ("5d", None),
        ("5F", None),
        ("", None),
        ("abc", None),
        (None, None),
    ],
)
def test_double(spark, value, expected):
    assert one(spark, value, lambda c: text.to_double(c, strict=False)) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("۶۴,۰۰۰,۱۲۸,۲۵۶", 64000128256),
        ("9,007,199,254,740,993", 9007199254740993),
        ("3.7", 3),
        ("-3.7", -3),
        ("x", None),
    ],
)
def test_bigint_is_exact_and_cuts(spark, value, expected):
    assert one(spark, value, lambda c: text.to_bigint(c, strict=False)) == expected


def test_whole_rejects_fractions(spark):
    assert one(spark, "٣,۴", text.to_whole) == 34
    assert one(spark, "3.7", lambda c: text.to_whole(c, strict=False)) is None


@pytest.mark.parametrize("function", [text.to_double, text.to_bigint, text.to_whole])
def test_strict_numbers_raise(spark, function):
    with pytest.raises(PySparkException):
        one(spark, "5d", function)


def test_strip_knows_unicode_whitespace(spark):
    assert one(spark, "　 \xa0\n a b \t ", text.strip) == "a b"


def test_letters(spark):
    assert one(spark, "يكی", text.normalize_letters) == "یکی"


def test_blank_and_infinite(spark):
    assert one(spark, " \n ", lambda c: text.to_double(c, blank_is_null=True)) is None
    assert one(spark, " ۵ ", lambda c: text.to_double(c, blank_is_null=True)) == 5.0
    assert one(spark, " ∞ ", lambda c: text.null_if_text(c, "∞")) is None
    assert one(spark, " 5 ", lambda c: text.null_if_text(c, "∞")) == "5"


@pytest.mark.parametrize(
    "url, domain, base",
    [
        ("https://Fund.example.ir:8080/x?y", "Fund.example.ir:8080", "https://fund.example.ir/"),
        ("http://a.ir", None, "http://a.ir/"),
        ("nothing", None, None),
        (None, None, None),
    ],
)
def test_urls(spark, url, domain, base):
    assert one(spark, url, text.url_domain) == domain
    assert one(spark, url, text.url_base) == base


@pytest.mark.parametrize("value", ["a<t>b<t>c", "no marker", "", "<t>", "x<t>", "<t>y"])
def test_markers_act_like_partition(spark, value):
    assert one(spark, value, lambda c: text.after_first(c, "<t>")) == value.partition("<t>")[2]
    assert one(spark, value, lambda c: text.before_first(c, "<t>")) == value.partition("<t>")[0]
    assert one(spark, value, lambda c: text.before_last(c, "<t>")) == value.rpartition("<t>")[0]
    last = value.rpartition("<t>")[2] if "<t>" in value else None
    assert one(spark, value, lambda c: text.after_last(c, "<t>")) == last


def test_us_dates(spark):
    assert one(spark, "4/8/2025", dates.us_date) == datetime.date(2025, 4, 8)
    assert one(spark, "12/31/2024", dates.us_date) == datetime.date(2024, 12, 31)
    assert one(spark, "31/12/2024", lambda c: dates.us_date(c, strict=False)) is None
    with pytest.raises(PySparkException):
        one(spark, "31/12/2024", dates.us_date)


def test_tehran_day_and_wall_clock(spark):
    def day(c):
        return dates.tehran_date(dates.instant(c))

    assert one(spark, "2025-04-28T23:59:59+03:30", day) == datetime.date(2025, 4, 28)
    assert one(spark, "2025-04-28T20:29:59Z", day) == datetime.date(2025, 4, 28)
    assert one(spark, "2025-04-28T20:30:00Z", day) == datetime.date(2025, 4, 29)
    # Summer time was in force in 2021.
    assert one(spark, "2021-06-01T19:30:00Z", day) == datetime.date(2021, 6, 2)
    clock = datetime.datetime(2025, 5, 7, 15, 31, 56)
    assert one(spark, "2025-05-07T15:31:56+03:30", dates.wall_clock) == clock
    assert one(spark, "2025-05-07T15:31:56", dates.wall_clock) == clock
