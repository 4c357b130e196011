"""Open records and the list of values that typed reading cuts."""

from decimal import Decimal

from pyspark.sql import functions as F

from fundlake.operators import allocation, compare, nav
from fundlake.operators.violations import parse_violations
from fundlake.sources.records import field, fields, open_records
from tests.test_plans import plan


def test_records_keep_undeclared_fields_and_all_digits(spark):
    body = '{"data":[{"a":1.25,"b":"x","c":{"z":[1]},"d":null,"e":123456789012345678901234.5,"it\'s":true},5,{}]}'
    rows = spark.createDataFrame([(1, body), (2, "nope"), (3, '{"data":3}'), (4, None)], "id int, body string")
    found = open_records(rows, ["id"], F.col("body"), "$.data")
    assert [(r["id"], r["pos"]) for r in found.collect()] == [(1, 0), (1, 1), (1, 2)]
    got = {r["field"]: (r["value"], r["kind"].split("(")[0].split("<")[0]) for r in fields(found, ["id"]).collect()}
    assert got == {
        "a": ("1.25", "DECIMAL"), "b": ("x", "STRING"), "c": ('{"z":[1]}', "OBJECT"), "d": (None, "VOID"),
        "e": ("123456789012345678901234.5", "DECIMAL"), "it's": ("true", "BOOLEAN"),
    }
    first = found.filter("pos = 0").select(field("a", "decimal(10,3)"), field("b", "int"), field("it's", "boolean"), field("x", "string"))
    assert tuple(first.first()) == (Decimal("1.250"), None, True, None)


def test_feeds_as_records(spark, land):
    rows = land(
        ("", "http://p/", "", "etf_list", 1, '{"data":[{"asset_id":"7","name":"n","new":1}]}'),
        ("MabnaDP2", "http://m/", "1", "navps_history", 1, '{"data":[{"date_time":"2024-01-01T00:00:00+03:30","new":2.5}]}'),
        ("RayanHamafza2", "http://r/", "1", "industries", 1, '[{"any":"x","share":3}]'),
    )
    assert compare.portal_records(rows).select("asset_id", "name", field("new", "int")).collect() == [("7", "n", 1)]
    chart = nav.mabna_records(rows).select(F.col("date").cast("string"), field("new", "double")).collect()
    assert chart == [("2024-01-01", 2.5)]
    assert {r["field"] for r in fields(allocation.open_industries(rows), ["url"]).collect()} == {"any", "share"}


def test_violations_name_every_cut_value_in_one_scan(spark, land):
    rows = land(
        ("MabnaDP2", "http://m/", "1", "navps_history", 1, '{"data":[{"total_unit_count":5},{"total_unit_count":5.5,"statistical_value":0.5}]}'),
        ("RayanHamafza2", "http://r/", "1", "dividend_history", 1, '[{"unitProfit":9223372036854775808,"fundUnit":-9223372036854775808}]'),
        ("RayanHamafza", "http://o/", "1", "dividend_history", 1, '{"data":[{"UnitProfit":"x","FundApId":0.5,"SumAllProfit":null}]}'),
        ("TadbirPardaz", "http://t/", "1", "live_navps", 1, '"{\\"subNav\\":\\"۱۵,۴۳۰.۸۲\\",\\"cancelNav\\":\\"۱,۰۰۰\\"}"'),
        ("TadbirPardaz", "http://b/", "1", "live_navps", 1, "<html>"),
        ("LeveragedTadbirPardaz", "http://l/", "1", "live_navps", 1, "<html>"),
    )
    found = parse_violations(rows)
    got = {(r["url"], r["pos"], r["field"], r["text"], r["reason"]) for r in found.collect()}
    assert got == {
        ("http://m/", 1, "total_unit_count", "5.5", "fraction"),
        ("http://r/", 0, "unitProfit", "9223372036854775808", "beyond 64 bits"),
        ("http://o/", 0, "unitProfit", "x", "no number"),
        ("http://t/", 0, "subNav", "۱۵,۴۳۰.۸۲", "fraction"),
        ("http://b/", 0, None, None, "unreadable body"),
    }
    assert found.filter("url = 'http://t/'").first()["number"] == Decimal("15430.82")
    text = plan(found)
    assert "Exchange" not in text and text.count("parse_json") <= 1
