"""Net-asset-value histories: landed chart, list and report bodies -> rows per fund and day.

Payload lists are exploded inside their own row, so all but the leveraged chart (which
aligns its series by date) run without a shuffle.
"""

from __future__ import annotations

import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake import schemas as S
from fundlake.functions import dates, jalali, text
from fundlake.functions.rows import exploded, inlined, keep_where
from fundlake.sources.landing import captured
from fundlake.sources import records
from fundlake.sources.payload import from_json, report_cells

CHART = "navps_history"


def in_range(
    rows: DataFrame,
    from_date: datetime.date | None = None,
    to_date: datetime.date | None = None,
) -> DataFrame:
    """Rows whose ``date`` lies between two optional bounds, both inclusive."""
    date, conditions = F.col("date"), []
    if from_date is not None:
        conditions.append(date >= F.lit(from_date))
    if to_date is not None:
        conditions.append(date <= F.lit(to_date))
    return keep_where(rows, reduce(and_, conditions)) if conditions else rows


def _chart_series(body: Column) -> Column:
    return from_json(body, S.TADBIR_CHART)


def _zipped_series() -> tuple[Column, Column]:
    """The three series of a ``chart`` column zipped by position, and whether they match."""
    lists = [F.get("chart", F.lit(i))["List"] for i in range(3)]
    even = (F.size(lists[0]) == F.size(lists[1])) & (F.size(lists[0]) == F.size(lists[2]))
    zipped = F.arrays_zip(
        lists[0]["x"].alias("x"),
        lists[0]["y"].alias("creation"),
        lists[1]["y"].alias("statistical"),
        lists[2]["y"].alias("redemption"),
    )
    return zipped, even


def tadbir_navps(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Three parallel series joined by position; the first one carries the dates.

    Order in the payload: creation, statistical, redemption. Series of unequal length are
    an error when ``strict``; otherwise ``uneven_charts`` lists them and no row is made.
    """
    rows = captured(responses, CHART, [C.TADBIR, C.TADBIR_MULTI])
    chart = rows.select(*S.KEY, _chart_series(F.col("body")).alias("chart"))
    zipped, even = _zipped_series()
    points = F.when(even, zipped)
    if strict:
        message = F.concat(F.lit("uneven chart series: "), F.col("url"))
        points = points.otherwise(F.raise_error(message))
    return inlined(chart, S.KEY, points).select(
        *S.KEY,
        dates.us_date(F.col("x"), strict).alias("date"),
        "creation",
        "redemption",
        "statistical",
    )


def uneven_charts(responses: DataFrame) -> DataFrame:
    """Charts whose three series differ in length, with the lengths."""
    rows = captured(responses, CHART, [C.TADBIR, C.TADBIR_MULTI])
    chart = rows.select(*S.KEY, _chart_series(F.col("body")).alias("chart"))
    sizes = chart.select(
        *S.KEY,
        *[
            F.coalesce(F.size(F.get("chart", F.lit(i))["List"]), F.lit(-1)).alias(name)
            for i, name in enumerate(["n_creation", "n_statistical", "n_redemption"])
        ],
    )
    return keep_where(
        sizes,
        (F.col("n_creation") != F.col("n_statistical"))
        | (F.col("n_creation") != F.col("n_redemption"))
        | (F.col("n_creation") < 0),
    )


def leveraged_points(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Points of a leveraged chart in long form: ``(fund, series, pos, text, date, value)``.

    ``text`` is the date as the payload writes it; where it is none, ``date`` is null.
    """
    rows = captured(responses, CHART, [C.TADBIR_LEVERAGED])
    chart = F.slice(_chart_series(F.col("body")), 1, len(C.LEVERAGED_SERIES))
    series = exploded(rows, S.KEY, chart, "s", "series")
    points = exploded(series, [*S.KEY, "series"], F.col("s.List"), "p")
    return points.select(
        *S.KEY,
        "series",
        "pos",
        F.col("p.x").alias("text"),
        dates.us_date(F.col("p.x"), strict).alias("date"),
        F.col("p.y").alias("value"),
    )


def leveraged_navps(responses: DataFrame, strict: bool = False, undated: bool = False) -> DataFrame:
    """Up to six series aligned by date, the first value of a repeated date winning.

    A full outer join of six de-duplicated series is six filtered aggregates over one
    grouping by fund and date: one shuffle, reduced on the map side, and a fund with a
    third of all points still spreads over its dates.

    Points without a date drop out; ``leveraged_undated`` lists them. With ``undated`` they stay
    as a chain of full joins leaves them: dates that are null match nothing, so each series
    that has such points (of which the first stays) adds a row of its own, told apart by the
    series in the grouping key.
    """
    points = leveraged_points(responses, strict)
    own = F.when(F.col("date").isNull(), F.col("series")).alias("own")
    points = points.select("*", own) if undated else keep_where(points, F.col("date").isNotNull())
    columns = []
    for i, name in enumerate(C.LEVERAGED_SERIES):
        mine = F.col("series") == i
        columns.append(
            F.min_by(F.when(mine, F.col("value")), F.when(mine, F.col("pos"))).alias(name)
        )
    if undated:
        return points.groupBy(*S.KEY, "date", "own").agg(*columns).drop("own")
    return points.groupBy(*S.KEY, "date").agg(*columns)


def leveraged_undated(responses: DataFrame) -> DataFrame:
    """The points of leveraged charts whose date cannot be read: ``(fund, series, pos, text, value)``, without a shuffle."""
    points = keep_where(leveraged_points(responses), F.col("date").isNull())
    name = F.array(*[F.lit(n) for n in C.LEVERAGED_SERIES])[F.col("series")]
    return points.select(*S.KEY, name.alias("series"), "pos", "text", "value")


def rayan_navps(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Records read by position: date, creation, redemption, statistical."""
    rows = captured(responses, CHART, C.RAYAN_FAMILY)
    parsed = from_json(F.col("body"), S.RAYAN_POSITIONAL, strict)
    records = exploded(rows, S.KEY, parsed, "r").select(*S.KEY, F.map_values("r").alias("v"))

    def number(i):
        value = F.get("v", F.lit(i))
        return value.cast("double") if strict else value.try_cast("double")

    return records.select(
        *S.KEY,
        jalali.to_date(F.get("v", F.lit(0)), strict).alias("date"),
        number(1).alias("creation"),
        number(2).alias("redemption"),
        number(3).alias("statistical"),
    )


def _mabna_chart(responses: DataFrame, endpoint: str, schema: str, strict: bool) -> DataFrame:
    rows = captured(responses, endpoint, [C.MABNA])
    flat = inlined(rows, S.KEY, from_json(F.col("body"), schema, strict)["data"])
    at = dates.instant(F.col("date_time"), strict)
    return flat.withColumn("date_time", at).withColumn("date", dates.tehran_date(F.col("date_time")))


def mabna_navps(responses: DataFrame, strict: bool = False) -> DataFrame:
    """All columns of the chart, three of them under their common names, plus ``date``."""
    chart = _mabna_chart(responses, CHART, S.MABNA_CHART, strict)
    return chart.withColumnsRenamed(
        {
            "purchase_price": "creation",
            "redemption_price": "redemption",
            "statistical_value": "statistical",
        }
    )


def mabna_records(responses: DataFrame) -> DataFrame:
    """The chart with all columns that the vendor sends: ``(fund, pos, date, record)``."""
    rows = captured(responses, CHART, [C.MABNA])
    found = records.open_records(rows, S.KEY, F.col("body"), "$.data")
    date = dates.tehran_date(dates.instant(records.field("date_time", "string"), strict=False))
    return found.select(*S.KEY, "pos", date.alias("date"), records.RECORD)


def mabna_assets(responses: DataFrame, strict: bool = False) -> DataFrame:
    """History of total assets: ``date_time``, ``value``, ``date``."""
    return _mabna_chart(responses, "assets_history", S.MABNA_ASSETS_CHART, strict)


def navps_history(responses: DataFrame) -> DataFrame:
    """Prices per unit of every fund: ``(fund, date, creation, redemption, statistical)``.

    The vendors whose payload is one list are read in a single scan; leveraged charts,
    which need a grouping, are read in a second one and have no statistical price.
    """
    listed = captured(responses, CHART, [C.TADBIR, C.TADBIR_MULTI, *C.RAYAN_FAMILY, C.MABNA])
    body, vendor = F.col("body"), F.col("site_type")
    tadbir, rayan = vendor.isin(C.TADBIR, C.TADBIR_MULTI), vendor.isin(*C.RAYAN_FAMILY)
    parsed = listed.select(
        *S.KEY,
        _chart_series(F.when(tadbir, body)).alias("chart"),
        from_json(F.when(rayan, body), S.RAYAN_POSITIONAL).alias("records"),
        from_json(F.when(vendor == C.MABNA, body), S.MABNA_CHART)["data"].alias("data"),
    )
    zipped, even = _zipped_series()

    def point(day, creation, redemption, statistical):
        return F.struct(
            day.alias("day"),
            creation.try_cast("double").alias("creation"),
            redemption.try_cast("double").alias("redemption"),
            statistical.try_cast("double").alias("statistical"),
        )

    charted = F.transform(
        zipped, lambda p: point(p["x"], p["creation"], p["redemption"], p["statistical"])
    )
    positional = F.transform(
        F.transform("records", lambda r: F.map_values(r)),
        lambda v: point(*[F.get(v, F.lit(i)) for i in range(4)]),
    )
    dated = F.transform(
        "data",
        lambda r: point(
            r["date_time"], r["purchase_price"], r["redemption_price"], r["statistical_value"]
        ),
    )
    points = F.when(tadbir & even, charted).when(rayan, positional).otherwise(dated)
    flat = inlined(parsed, S.KEY, points)
    day = F.col("day")
    date = (
        F.when(vendor == C.MABNA, dates.tehran_date(dates.instant(day, strict=False)))
        .when(vendor.isin(*C.RAYAN_FAMILY), jalali.to_date(day, strict=False))
        .otherwise(dates.us_date(day, strict=False))
    )
    common = flat.select(*S.KEY, date.alias("date"), "creation", "redemption", "statistical")
    leveraged = leveraged_navps(responses).select(
        *S.KEY, "date", "creation", "redemption", F.lit(None).cast("double").alias("statistical")
    )
    return common.unionByName(leveraged)


def nav_report(
    responses: DataFrame,
    from_date: datetime.date | None = None,
    to_date: datetime.date | None = None,
    basket_id: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """The 21-column report: twenty numbers, the Jalali date as text, and ``date``.

    Short rows end in nulls and long rows are cut; blank cells are null. The text column is
    called ``Jalali Date`` because Spark takes ``Date`` and ``date`` for one name.
    """
    pages = captured(responses, "nav_history", C.TADBIR_FAMILY)
    if basket_id is not None:
        pages = pages.filter(F.col("portfolio_id") == basket_id)
    keep = [*S.KEY, "page"]
    cells = report_cells(pages, keep, until_last=False)
    columns = []
    for i, name in enumerate(C.NAV_REPORT_COLUMNS):
        cell = F.get("cells", F.lit(i))
        if name == "Date":
            columns.append(cell.alias("Jalali Date"))
            columns.append(jalali.to_date(cell, strict).alias("date"))
        else:
            columns.append(text.to_double(cell, strict, blank_is_null=True).alias(name))
    return in_range(cells.select(*keep, "pos", *columns), from_date, to_date)


def rayan_daily_nav(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Arrays of ``[nav, Jalali date, creation price]`` -> ``(nav, date, creation_navps)``."""
    rows = captured(responses, "nav_history", C.RAYAN_FAMILY)
    records = exploded(rows, S.KEY, from_json(F.col("body"), S.RAYAN_DAILY, strict), "r")

    def number(i):
        value = F.get("r", F.lit(i))
        return value.cast("double") if strict else value.try_cast("double")

    return records.select(
        *S.KEY,
        number(0).alias("nav"),
        jalali.to_date(F.get("r", F.lit(1)), strict).alias("date"),
        number(2).alias("creation_navps"),
    )


def price_violations(history: DataFrame) -> DataFrame:
    """Rows of a price history whose redemption price exceeds the creation price."""
    return keep_where(history, F.col("redemption") > F.col("creation"))
