"""Dividend histories from HTML reports and JSON lists."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake import schemas as S
from fundlake.functions import jalali, text
from fundlake.functions.rows import inlined
from fundlake.operators.nav import in_range
from fundlake.sources.landing import captured
from fundlake.sources.payload import from_json, report_cells

ENDPOINT = "dividend_history"


def report_dividends(
    responses: DataFrame,
    from_date: datetime.date | None = None,
    to_date: datetime.date | None = None,
    strict: bool = False,
) -> DataFrame:
    """HTML dividend reports of all funds and pages; an infinite percentage is null.

    No shuffle: every page is parsed where it was read.
    """
    pages = captured(responses, ENDPOINT, C.TADBIR_FAMILY)
    keep = [*S.KEY, "page"]
    cells = report_cells(pages, keep, until_last=True)
    cell = {name: F.get("cells", F.lit(i)) for i, name in enumerate(C.DIVIDEND_COLUMNS)}
    rows = cells.select(
        *keep,
        "pos",
        text.to_bigint(cell["row"], strict).alias("row"),
        jalali.to_date(cell["date"], strict).alias("date"),
        text.to_bigint(cell["fundUnit"], strict).alias("fundUnit"),
        text.to_bigint(cell["unitProfit"], strict).alias("unitProfit"),
        text.to_bigint(cell["sumAllProfit"], strict).alias("sumAllProfit"),
        text.to_double(text.null_if_text(cell["profitPercent"], "∞"), strict).alias(
            "profitPercent"
        ),
    )
    return in_range(rows, from_date, to_date)


def json_dividends(responses: DataFrame, strict: bool = False) -> DataFrame:
    """JSON dividend lists: nine whole numbers, ``profitDate`` as text, and ``date``.

    The older vendor wraps the list in ``data`` and capitalises its names.
    """
    body, vendor = F.col("body"), F.col("site_type")
    plain = S.dividend_json()
    capitalised = S.dividend_json(lambda name: name[0].upper() + name[1:])
    wrapped = from_json(body, f"data {capitalised}", strict)["data"].cast(plain)
    records = F.when(vendor == C.RAYAN, wrapped).otherwise(from_json(body, plain, strict))
    rows = captured(responses, ENDPOINT, C.RAYAN_FAMILY)
    flat = inlined(rows, S.KEY, records)
    return flat.withColumn("date", jalali.to_date(F.col("profitDate"), strict))


def all_dividends(
    responses: DataFrame,
    from_date: datetime.date | None = None,
    to_date: datetime.date | None = None,
) -> DataFrame:
    """Dividends of every vendor under common names, in the given range of dates (both inclusive).

    ``(fund, date, fundUnit, unitProfit, sumAllProfit, profitPercent)``. JSON lists send no
    percentage, so theirs is null. Reports and lists lie in the same endpoint but need
    different parsers: two scans, each filtered by vendor, and no shuffle.
    """
    common = [*S.KEY, "date", "fundUnit", "unitProfit", "sumAllProfit"]
    reports = report_dividends(responses, from_date, to_date).select(*common, "profitPercent")
    lists = in_range(json_dividends(responses), from_date, to_date).select(*common, F.lit(None).cast("double").alias("profitPercent"))
    return reports.unionByName(lists)


def payout_per_fund(dividends: DataFrame) -> DataFrame:
    """Number of payments, their total, and the first and last date of each fund.

    The total is a wide decimal: payouts of a large fund exceed 64 bits sooner or later.
    """
    return dividends.groupBy(*S.KEY).agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.sum(F.col("sumAllProfit").cast("decimal(38,0)")).alias("total_profit"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
