"""Dividend histories: HTML reports and JSON lists."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import jalali, text
from fundlake.operators import dividends as D
from fundlake.sources.landing import incomplete_reports
from workloads.encode import cents, date_text, fa_commas, html_table, landed, site_url
from workloads.registry import query

_NEXT = '<a href="?page=2" title="Next page">»</a>'
_FROM, _TO = datetime.date(1996, 1, 1), datetime.date(1999, 12, 31)


def report_pages(t):
    """One report page with three payments per order."""
    c, key = cents("o_totalprice"), F.col("o_orderkey")
    thousandths = F.lpad(F.pmod(c, F.lit(1000)).cast("string"), 3, "0")
    percent = F.concat(
        fa_commas(F.call_function("div", c, F.lit(1000))),
        F.lit("."),
        text.persian_digits(thousandths),
    )
    rows = []
    for k in (1, 2, 3):
        day = F.date_add(F.col("o_orderdate").cast("date"), 30 * k)
        shown = F.when((key + k) % 5 == 0, F.lit("∞")).otherwise(percent)
        rows.append(
            [
                fa_commas(F.lit(k)),
                text.persian_digits(jalali.from_date(day)),
                fa_commas(key * 1000 + k),
                fa_commas(F.col("o_custkey") + 100 * k),
                fa_commas(c * k),
                F.concat(F.lit(" "), shown, F.lit(" ")),
            ]
        )
    return landed(
        t.orders,
        C.TADBIR,
        site_url("fund", "o_custkey"),
        D.ENDPOINT,
        html_table(rows, after=_NEXT),
        page=key,
    )


_PAYMENTS = """
    SELECT o_orderkey, o_custkey, k, CAST(round(o_totalprice * 100) AS BIGINT) AS c,
      CAST(o_orderdate AS DATE) + CAST(30 * k AS INTEGER) AS d
    FROM orders, range(1, 4) r(k)
"""


@query(
    "dividend_html",
    f"""
    SELECT 'http://fund' || o_custkey || '.example.ir/' AS url, CAST(o_orderkey AS BIGINT) AS page,
      CAST(k AS BIGINT) AS row_no, strftime(d, '%Y-%m-%d') AS day,
      o_orderkey * 1000 + k AS units, o_custkey + 100 * k AS unit_profit,
      c * k AS total_profit,
      CASE WHEN (o_orderkey + k) % 5 = 0 THEN NULL ELSE c / 1000.0 END AS percent
    FROM ({_PAYMENTS}) WHERE d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
    """,
)
def dividend_html(t):
    rows = D.report_dividends(report_pages(t), _FROM, _TO)
    return rows.select(
        "url",
        F.col("page").cast("bigint").alias("page"),
        F.col("row").alias("row_no"),
        date_text("date").alias("day"),
        F.col("fundUnit").alias("units"),
        F.col("unitProfit").alias("unit_profit"),
        F.col("sumAllProfit").alias("total_profit"),
        F.col("profitPercent").alias("percent"),
    )


@query(
    "dividend_payout",
    f"""
    SELECT 'http://fund' || o_custkey || '.example.ir/' AS url, count(*) AS n_payments,
      CAST(sum(c * k) AS BIGINT) AS total_profit,
      strftime(min(d), '%Y-%m-%d') AS first_day, strftime(max(d), '%Y-%m-%d') AS last_day
    FROM ({_PAYMENTS}) GROUP BY o_custkey
    """,
)
def dividend_payout(t):
    paid = D.payout_per_fund(D.report_dividends(report_pages(t)))
    return paid.select(
        "url",
        "n_payments",
        F.col("total_profit").cast("bigint").alias("total_profit"),
        date_text("first_date").alias("first_day"),
        date_text("last_date").alias("last_day"),
    )


@query(
    "report_pages_complete",
    """
    WITH p AS (
      SELECT l_orderkey, l_linenumber,
        l_linenumber < max(l_linenumber) OVER (PARTITION BY l_orderkey) OR l_orderkey % 4 = 0
          AS has_next
      FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    )
    SELECT 'http://fund' || l_orderkey || '.example.ir/' AS url,
      CAST(min(l_linenumber) AS BIGINT) AS first_page, CAST(max(l_linenumber) AS BIGINT) AS last_page,
      count(DISTINCT l_linenumber) AS n_pages, l_orderkey % 4 = 0 AS continues
    FROM p GROUP BY l_orderkey
    HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(DISTINCT l_linenumber)
      OR l_orderkey % 4 = 0
    """,
)
def report_pages_complete(t):
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("last"))
    lines = t.lineitem.join(last, "l_orderkey")
    goes_on = (F.col("l_linenumber") < F.col("last")) | (F.col("l_orderkey") % 4 == 0)
    body = F.concat(
        F.lit("<tbody><tr><td>1</td></tr></tbody>"), F.when(goes_on, F.lit(_NEXT)).otherwise("")
    )
    pages = landed(
        lines, C.TADBIR, site_url("fund", "l_orderkey"), D.ENDPOINT, body, page=F.col("l_linenumber")
    )
    found = incomplete_reports(pages)
    return found.select(
        "url",
        F.col("first_page").cast("bigint").alias("first_page"),
        F.col("last_page").cast("bigint").alias("last_page"),
        "n_pages",
        "continues",
    )


@query(
    "dividend_json",
    """
    SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS fund_unit,
      o_custkey AS unit_profit, o_custkey * 3 AS sum_unit_profit,
      CAST(round(o_totalprice * 100) AS BIGINT) * 7 AS sum_all_profit,
      strftime(o_orderdate, '%Y-%m-%d') AS day,
      CASE WHEN o_orderkey % 2 = 0 THEN 'RayanHamafza' ELSE 'RayanHamafza2' END AS site_type
    FROM orders
    """,
)
def dividend_json(t):
    rows = D.json_dividends(list_pages(t))
    return rows.select(
        F.col("fundId").alias("o_orderkey"),
        F.col("fundUnit").alias("fund_unit"),
        F.col("unitProfit").alias("unit_profit"),
        F.col("sumUnitProfit").alias("sum_unit_profit"),
        F.col("sumAllProfit").alias("sum_all_profit"),
        date_text("date").alias("day"),
        "site_type",
    )


def list_pages(t):
    """One payment per order as a JSON list in the two spellings."""
    values = {
        "fundId": F.col("o_orderkey"),
        "profitDate": jalali.from_date(F.col("o_orderdate").cast("date")),
        "fundUnit": cents("o_totalprice"),
        "profitGuaranteeUnit": F.lit(0),
        "unitProfit": F.col("o_custkey"),
        "extraProfit": F.lit(0),
        "sumUnitProfit": F.col("o_custkey") * 3,
        "sumExtraProfit": F.lit(0),
        "sumProfitGuarantee": F.lit(0),
        "sumAllProfit": cents("o_totalprice") * 7,
    }
    plain = F.array(F.struct(*[v.alias(n) for n, v in values.items()]))
    capital = F.struct(
        F.col("o_orderkey").alias("FundApId"),
        *[v.alias(n[0].upper() + n[1:]) for n, v in values.items()],
    )
    old = F.col("o_orderkey") % 2 == 0
    body = F.when(old, F.to_json(F.struct(F.array(capital).alias("data")))).otherwise(
        F.to_json(plain)
    )
    return landed(
        t.orders,
        F.when(old, F.lit(C.RAYAN)).otherwise(F.lit(C.RAYAN2)),
        site_url("fund", "o_orderkey"),
        D.ENDPOINT,
        body,
    )


@query(
    "dividends_all_vendors",
    f"""
    SELECT 'TadbirPardaz' AS site_type, 'http://fund' || o_custkey || '.example.ir/' AS url, strftime(d, '%Y-%m-%d') AS day,
      o_orderkey * 1000 + k AS units, o_custkey + 100 * k AS unit_profit, c * k AS total_profit,
      CASE WHEN (o_orderkey + k) % 5 = 0 THEN NULL ELSE c / 1000.0 END AS percent
    FROM ({_PAYMENTS}) WHERE d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
    UNION ALL
    SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'RayanHamafza' ELSE 'RayanHamafza2' END, 'http://fund' || o_orderkey || '.example.ir/',
      strftime(o_orderdate, '%Y-%m-%d'), CAST(round(o_totalprice * 100) AS BIGINT), o_custkey,
      CAST(round(o_totalprice * 100) AS BIGINT) * 7, NULL
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
    """,
)
def dividends_all_vendors(t):
    rows = D.all_dividends(report_pages(t).unionByName(list_pages(t)), _FROM, _TO)
    return rows.select(
        "site_type",
        "url",
        date_text("date").alias("day"),
        F.col("fundUnit").alias("units"),
        F.col("unitProfit").alias("unit_profit"),
        F.col("sumAllProfit").alias("total_profit"),
        F.col("profitPercent").alias("percent"),
    )
