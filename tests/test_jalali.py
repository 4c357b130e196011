import datetime

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundlake.functions import jalali, text


def calendar(first_year, last_year, first_day):
    """Every day of a span, from the leap-year list alone."""
    rows, day = [], first_day
    for year in range(first_year, last_year + 1):
        leap = year % 33 in (1, 5, 9, 13, 17, 22, 26, 30)
        for month in range(1, 13):
            length = 31 if month <= 6 else 30 if month <= 11 else 30 if leap else 29
            for d in range(1, length + 1):
                rows.append((day, year, month, d))
                day += datetime.timedelta(days=1)
    return rows


@pytest.fixture(scope="module")
def days(spark):
    rows = calendar(1200, 1599, datetime.date(1821, 3, 21))
    frame = pd.DataFrame(rows, columns=["day", "y", "m", "d"])
    return spark.createDataFrame(frame, "day date, y int, m int, d int")


def test_every_day_of_four_centuries(days):
    padded = F.format_string("%04d/%02d/%02d", "y", "m", "d").alias("padded")
    unpadded = F.concat_ws("/", *[F.col(c).cast("string") for c in "ymd"]).alias("unpadded")
    texts = days.select("day", padded, unpadded)
    got = texts.select(
        "day",
        "padded",
        "unpadded",
        jalali.to_date(F.col("padded")).alias("a"),
        jalali.to_date(text.persian_digits(F.col("unpadded"))).alias("b"),
        jalali.from_date(F.col("day")).alias("c"),
        jalali.from_date(F.col("day"), padded=False).alias("e"),
    ).toPandas()
    assert len(got) == 146097
    assert (got["a"] == got["day"]).all()
    assert (got["b"] == got["day"]).all()
    assert (got["c"] == got["padded"]).all()
    assert (got["e"] == got["unpadded"]).all()


def one(spark, value, function):
    rows = spark.createDataFrame([(value,)], "c string")
    return rows.select(function(F.col("c")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1403/10/30", datetime.date(2025, 1, 19)),
        ("۱۴۰۳/۰۸/۳۰", datetime.date(2024, 11, 20)),
        ("1404/6/31", datetime.date(2025, 9, 22)),
        (" 1403/1/1 ", datetime.date(2024, 3, 20)),
        ("1403/12/30", datetime.date(2025, 3, 20)),
        ("1402/12/30", None),
        ("1402/13/1", None),
        ("1402/0/1", None),
        ("1402/7/31", None),
        ("1402/1/32", None),
        ("0/1/1", None),
        ("1402/1", None),
        ("1402/1/1/1", None),
        ("x/1/1", None),
        ("99999999999/1/1", None),
        ("2147483647/2147483647/2147483647", None),
        ("1402/-2147483648/1", None),
        ("32767/12/30", None),
        ("", None),
        (None, None),
    ],
)
def test_single_dates(spark, value, expected):
    assert one(spark, value, lambda c: jalali.to_date(c, strict=False)) == expected


def test_strict_dates_raise(spark):
    assert one(spark, None, jalali.to_date) is None
    with pytest.raises(PySparkException, match="not a Jalali date"):
        one(spark, "1402/13/1", jalali.to_date)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("۱۴۰۱/۱۰/۲۱ ۱۵:۵۸:۱۴", datetime.datetime(2023, 1, 11, 15, 58, 14)),
        ("1404/12/09 1:07:04", datetime.datetime(2026, 2, 28, 1, 7, 4)),
        ("۱۴۰۲/۰۸/۲۲ ", datetime.datetime(2023, 11, 13)),
        ("1402/08/22", datetime.datetime(2023, 11, 13)),
        ("1402/08/22 25:00:00", None),
        ("1402/08/22 noon", None),
        ("1402/08/22 10:00", None),
        (None, None),
    ],
)
def test_timestamps(spark, value, expected):
    assert one(spark, value, lambda c: jalali.to_timestamp(c, strict=False)) == expected


def test_strict_timestamps_raise(spark):
    with pytest.raises(PySparkException, match="not a Jalali timestamp"):
        one(spark, "1402/08/22 noon", jalali.to_timestamp)
