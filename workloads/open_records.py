"""Feeds that are passed through whole: fields that no schema declares reach the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.operators import allocation as A
from fundlake.operators import compare
from fundlake.operators import nav as N
from fundlake.operators.violations import DIVIDENDS, QUOTES, parse_violations
from fundlake.sources.records import fields
from workloads.encode import cents, date_text, fa_commas, json_text, landed, site_url
from workloads.registry import query


@query(
    "portal_fields",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS asset_id, c_name AS name, unnest(['asset_id', 'name', 'segment', 'nested', 'gap']) AS field,
      unnest([CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, '{"nation":' || c_nationkey || '}', NULL]) AS value
    FROM customer
    """,
)
def portal_fields(t):
    """Portal lists of one asset each, with three fields beside the two that the list declares."""
    asset = F.to_json(
        F.struct(
            F.col("c_custkey").cast("string").alias("asset_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.struct(F.col("c_nationkey").alias("nation")).alias("nested"),
        )
    )
    body = F.concat(F.lit('{"data":['), F.regexp_replace(asset, r"\}$", ',"gap":null}'), F.lit("]}"))
    lists = landed(t.customer, "", F.lit("http://portal.example.ir/"), "etf_list", body)
    return fields(compare.portal_records(lists), ["asset_id", "name"]).select("asset_id", "name", "field", "value")


@query(
    "chart_fields",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, unnest(['purchase_price', 'spread']) AS field,
      unnest([CAST(round(value * 100) AS BIGINT) || '.25', CAST(event_id % 7 AS VARCHAR)]) AS value,
      unnest(['DECIMAL', 'BIGINT']) AS kind
    FROM events
    """,
)
def chart_fields(t):
    """Charts with a price that has decimals and a column that the chart's schema lacks."""
    price = (cents("value") + F.lit("0.25").cast("decimal(3,2)")).alias("purchase_price")
    at = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T12:00:00+03:30")).alias("date_time")
    point = F.struct(at, price, (F.col("event_id") % 7).alias("spread"))
    body = F.to_json(F.struct(F.array(point).alias("data")))
    rows = landed(t.events, C.MABNA, F.lit("http://mabna.example.ir/"), N.CHART, body, portfolio_id=F.col("event_id"))
    found = fields(N.mabna_records(rows), ["portfolio_id", "date"]).filter("field <> 'date_time'")
    kind = F.regexp_extract("kind", "^[A-Z]+", 0).alias("kind")
    return found.select(F.col("portfolio_id").cast("bigint").alias("event_id"), date_text("date").alias("day"), "field", "value", kind)


@query(
    "industry_fields",
    """
    SELECT s_suppkey, CAST(i AS INTEGER) AS pos, unnest(['industryName', 'share', 'since']) AS field,
      unnest([s_name, CAST(s_nationkey + i AS VARCHAR), '14' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0')]) AS value
    FROM supplier, range(0, 2) r(i)
    """,
)
def industry_fields(t):
    """Two industries a fund, with a field more than the two that other readers know."""
    since = F.concat(F.lit("14"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0"))
    record = [
        F.struct(F.col("s_name").alias("industryName"), (F.col("s_nationkey") + i).alias("share"), since.alias("since")) for i in range(2)
    ]
    rows = landed(t.supplier, C.RAYAN2, site_url("i", "s_suppkey"), "industries", F.to_json(F.array(*record)), portfolio_id=F.col("s_suppkey"))
    found = fields(A.open_industries(rows), ["portfolio_id", "pos"])
    return found.select(F.col("portfolio_id").cast("bigint").alias("s_suppkey"), "pos", "field", "value")


@query(
    "parse_violations",
    """
    WITH c AS (SELECT c_custkey AS k, CAST(round(c_acctbal * 100) AS BIGINT) AS v FROM customer)
    SELECT k, 'navps_history' AS endpoint, 'total_unit_count' AS field, k || '.25' AS text, k + 0.25 AS number, 'fraction' AS reason
    FROM c WHERE k % 3 = 0 AND k % 2 = 0
    UNION ALL SELECT k, 'dividend_history', 'unitProfit', v || '.5', CAST(v || '.5' AS DOUBLE), 'fraction' FROM c WHERE k % 3 = 1 AND k % 5 = 0 AND k % 2 = 0
    UNION ALL SELECT k, 'dividend_history', 'fundUnit', 'n/a', NULL, 'no number' FROM c WHERE k % 3 = 1 AND k % 4 = 0
    UNION ALL SELECT k, 'live_navps', 'subNav', k || '.75', k + 0.75, 'fraction' FROM c WHERE k % 3 = 2 AND k % 7 = 0
    UNION ALL SELECT k, 'live_navps', NULL, NULL, NULL, 'unreadable body' FROM c WHERE k % 3 = 2 AND k % 7 = 1
    """,
)
def violations(t):
    """Three kinds of payload; some of their whole numbers have fractions, one is text, some bodies are broken."""
    k, v = F.col("c_custkey"), cents("c_acctbal")
    units = F.when(k % 2 == 0, F.concat(k, F.lit(".25"))).otherwise(k.cast("string"))
    chart = F.concat(F.lit('{"data":[{"total_unit_count":'), units, F.lit(',"purchase_price":1.5,"today_purchase_count":null}]}'))
    profit = F.when(k % 5 == 0, F.concat(v, F.lit(".5"))).otherwise(v.cast("string"))
    unit = F.when(k % 4 == 0, F.lit('"n/a"')).otherwise(v.cast("string"))
    plain = F.concat(F.lit('[{"unitProfit":'), profit, F.lit(',"fundUnit":'), unit, F.lit(',"profitDate":"1403/01/01","new":0.5}]'))
    capital = F.concat(F.lit('{"data":[{"UnitProfit":7,"FundUnit":'), unit, F.lit("}]}"))
    price = F.when(k % 7 == 0, F.concat(k, F.lit(".75"))).otherwise(k.cast("string"))
    quote = F.to_json(F.struct(price.alias("subNav"), fa_commas(v).alias("cancelNav")))
    live = F.when(k % 7 == 1, F.lit("<html>")).otherwise(json_text(quote))
    old = k % 2 == 1
    kind = F.when(k % 3 == 0, 0).when(k % 3 == 1, 1).otherwise(2)
    rows = landed(
        t.customer,
        F.when(kind == 0, C.MABNA).when(kind == 1, F.when(old, C.RAYAN).otherwise(C.RAYAN2)).otherwise(C.TADBIR),
        F.lit("http://v.example.ir/"),
        F.when(kind == 0, N.CHART).when(kind == 1, DIVIDENDS).otherwise(QUOTES),
        F.when(kind == 0, chart).when(kind == 1, F.when(old, capital).otherwise(plain)).otherwise(live),
        portfolio_id=k,
    )
    found = parse_violations(rows)
    number = F.col("number").cast("double").alias("number")
    return found.select(F.col("portfolio_id").cast("bigint").alias("k"), "endpoint", "field", "text", number, "reason")
