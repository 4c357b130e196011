"""Operators on hand-written payloads of each vendor."""

import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.operators import allocation, compare, dividends, nav, quotes, sites
from fundlake.plans.scan_funds import read_scan, store_cash
from fundlake.sources.landing import (
    for_portfolio,
    incomplete_reports,
    latest_capture,
    portfolio_or_default,
)
from fundlake.sources.payload import page_state

NEXT = '<a href="/Reports?page=2" title="Next page">»</a>'
FA = str.maketrans("0123456789", "۰۱۲۳۴۵۶۷۸۹")


def dividend_page(rows, more):
    """Report page; the middle cell spacing and the blank line are as sites send them."""
    trs = "".join(
        "<tr>\n" + "".join(f"  <td>{cell}</td>\n" for cell in row) + "\n</tr>\n   " for row in rows
    )
    table = f"<table><thead><tr><th>x</th></tr></thead><tbody>\n  {trs}</tbody></table>"
    return f"<html><tr><td>before</td></tr>{table}{NEXT if more else ''}</html>"


def dividend_row(i, day, percent=" ۱۲.۷۵ "):
    units = f"{512001024 + i:,}".translate(FA)
    return [str(i).translate(FA), day.translate(FA), units, "۱۲۵", "۶۴,۰۰۰,۱۲۸,۲۵۶", percent]


def report(land, pages):
    return land(
        *[
            (C.TADBIR, "http://a.ir/", "", "dividend_history", n + 1, dividend_page(rows, more))
            for n, (rows, more) in enumerate(pages)
        ]
    )


@pytest.fixture(scope="module")
def three_pages(land):
    rows = [dividend_row(i, f"1402/{i % 12 + 1}/1") for i in range(22)]
    return report(land, [(rows[:10], True), (rows[10:20], True), (rows[20:], False)])


def test_dividends_of_three_pages(three_pages):
    rows = dividends.report_dividends(three_pages, strict=True).orderBy("page", "pos").collect()
    assert len(rows) == 22
    assert [r["row"] for r in rows] == list(range(22))
    assert rows[1]["fundUnit"] == 512001025
    assert rows[0]["sumAllProfit"] == 64000128256
    assert rows[0]["profitPercent"] == 12.75
    assert incomplete_reports(three_pages).count() == 0


def test_a_failed_page_is_missing(land):
    page = lambda n, status, more: land(
        (C.TADBIR, "http://a.ir/", "", "dividend_history", n, dividend_page([dividend_row(1, "1402/1/1")], more)), status=status
    )
    pages = page(1, 200, True).unionByName(page(2, 500, True)).unionByName(page(3, 200, False))
    assert incomplete_reports(pages).count() == 1


def test_a_failed_fetch_hides_no_answer(land):
    good = land((C.TADBIR, "http://a.ir/", "", "live_navps", 1, "one"))
    later = land((C.TADBIR, "http://a.ir/", "", "live_navps", 1, "two"), status=500)
    moved = later.withColumn("fetched_at", F.current_timestamp().cast(later.schema["fetched_at"].dataType))
    kept = latest_capture(good.unionByName(good).unionByName(moved)).collect()
    assert [r["body"] for r in kept] == ["one"]


def test_no_fund_is_lost_where_captures_are_read_in_another_order(spark, land):
    """Of equal times one capture stays, whatever the order of the rows in each read."""
    from tests.llm.test_contracts import restless

    rows = [(C.TADBIR, f"http://{i % 40}.ir/", None, "home", 1, f"body {i}") for i in range(200)]
    kept = latest_capture(restless(land(*rows, *rows))).collect()
    assert sorted(r["url"] for r in kept) == sorted({r[1] for r in rows})
    again = latest_capture(restless(land(*rows, *rows))).collect()
    assert sorted(r["body"] for r in again) == sorted(r["body"] for r in kept)


def test_incomplete_reports(land, three_pages):
    gap = three_pages.filter(F.col("page") != 2)
    cut = three_pages.filter(F.col("page") < 3)
    assert incomplete_reports(gap).count() == 1
    assert incomplete_reports(cut).first()["continues"]


def test_dividend_range_is_inclusive(land):
    days = ["1403/08/29", "1403/08/30", "1403/12/01", "1404/06/31", "1404/07/01"]
    rows = report(land, [([dividend_row(i, d) for i, d in enumerate(days)], False)])
    bounds = datetime.date(2024, 11, 20), datetime.date(2025, 9, 22)
    got = dividends.report_dividends(rows, *bounds).select("row").collect()
    assert [r["row"] for r in got] == [1, 2, 3]
    assert dividends.report_dividends(rows, from_date=bounds[0]).count() == 4
    assert dividends.report_dividends(rows, to_date=bounds[1]).count() == 4


def test_absurd_and_infinite_percentages(land):
    absurd = dividend_row(1, "1403/10/30", " ۱,۸۱۶,۷۱۱,۶۹۳,۵۶۹,۰۷۰,۰۰۰ ")
    rows = report(land, [([absurd, dividend_row(2, "1403/10/30", "∞")], False)])
    got = dividends.report_dividends(rows, strict=True).orderBy("row").collect()
    assert got[0]["profitPercent"] == 1.81671169356907e18
    assert got[0]["date"] == datetime.date(2025, 1, 19)
    assert got[1]["profitPercent"] is None


def test_empty_report_keeps_its_schema(land, three_pages):
    empty = dividends.report_dividends(report(land, [([], False)]))
    assert empty.count() == 0
    assert empty.schema == dividends.report_dividends(three_pages).schema


def test_bad_cells(land):
    rows = report(land, [([dividend_row(1, "1403/13/30")], False)])
    assert dividends.report_dividends(rows).first()["date"] is None
    with pytest.raises(PySparkException, match="not a Jalali date"):
        dividends.report_dividends(rows, strict=True).collect()


def test_failed_status_is_left_out(land):
    body = dividend_page([dividend_row(1, "1403/1/1")], False)
    failed = land((C.TADBIR, "http://a.ir/", "", "dividend_history", 1, body), status=500)
    assert dividends.report_dividends(failed).count() == 0


def test_dividend_table_ends_at_the_last_marker(land):
    inner = "<tr><td>۱</td><td>1403/1/1</td></tr></tbody><tbody><tr><td>۲</td><td>1403/1/2</td></tr>"
    body = f"<tbody>{inner}</tbody>"
    rows = land(
        (C.TADBIR, "http://a.ir/", "", "dividend_history", 1, body),
        (C.TADBIR, "http://a.ir/", "0", "nav_history", 1, body),
    )
    # The two rows have other text than blanks between them, so they stay one row of cells.
    assert dividends.report_dividends(rows).count() == 1
    assert nav.nav_report(rows).first()["Jalali Date"] == "1403/1/1"


def test_nav_report_pads_cuts_and_selects(land):
    def page(*rows):
        trs = "</tr> <tr>".join("".join(f"<td>{c}</td>" for c in row) for row in rows)
        return f"<tbody><tr>{trs}</tr></tbody>"

    short = ["۱", "1404/04/17", "۱۰,۵۰۰.۵", "", " "]
    long = ["۲", "1404/04/18", *["۳"] * 18, "۴", "beyond", "end"]
    responses = land(
        (C.TADBIR_LEVERAGED, "http://l.ir/", "0", "nav_history", 1, page(short, long)),
        (C.TADBIR_LEVERAGED, "http://l.ir/", "7", "nav_history", 1, page(short)),
    )
    rows = nav.nav_report(responses, basket_id="0", strict=True).orderBy("pos").collect()
    assert len(rows) == 2
    assert rows[0]["Issue Price"] == 10500.5
    assert rows[0]["Redemption Price"] is None and rows[0]["Statistical Price"] is None
    assert rows[0]["Number of Normal Unit Investors"] is None
    assert rows[1]["Number of Normal Unit Investors"] == 4.0
    assert rows[1]["date"] == datetime.date(2025, 7, 9)
    numbers = [t for n, t in nav.nav_report(responses).dtypes if n in C.NAV_REPORT_COLUMNS]
    assert numbers == ["double"] * 20
    late = nav.nav_report(responses, from_date=datetime.date(2025, 7, 9))
    assert late.count() == 1


def tadbir_quote(**changes):
    record = {
        "subNav": "۲۰,۴۱۷",
        "cancelNav": "۲۰,۳۰۵",
        "esmiNav": "۲۰,۳۰۵",
        "publishDate": "۱۴۰۲/۰۹/۰۱ ۱۵:۵۸:۱۲",
        "maxUnit": "500,250,125",
        "totalUnit": "199,749,875",
        "totalNetAssetValue": "4,100,250,750,125",
        "navDate": "1402/08/30",
        "dailyTotalNetAssetValue": "۴,۱۰۰,۱۲۵,۲۵۰,۵۰۰",
    } | changes
    return json.dumps(json.dumps(record, ensure_ascii=False), ensure_ascii=False)


def leveraged_quote():
    record = {
        "BaseUnitsCancelNAV": "۱۱,۲۵۰.۷۵",
        "BaseUnitsTotalNetAssetValue": "۹,۰۰۰,۴۵۰,۹۰۰,۳۰۰",
        "BaseUnitsTotalSubscription": "۸۰۰,۰۴۰,۰۸۰",
        "SuperUnitsCancelNAV": "۲۱,۶۰۸",
        "SuperUnitsSubscriptionNAV": "۲۱,۷۳۳",
        "SuperUnitsTotalSubscription": "۷۰۰,۳۰۰,۰۰۰",
        "SuperUnitsTotalNetAssetValue": "۱۵,۱۳۲,۰۸۲,۴۰۰,۰۰۰",
        "PublishDate": "۱۴۰۱/۱۰/۲۱ ۱۵:۵۸:۱۴",
    }
    return json.dumps(json.dumps(record))


def test_tadbir_quote(land):
    rows = land(
        (C.TADBIR, "http://a.ir/", "", "live_navps", 1, tadbir_quote()),
        (C.TADBIR_MULTI, "http://m.ir/", "3", "live_navps", 1, tadbir_quote(publishDate="۱۴۰۲/۰۸/۲۲ ")),
    )
    first, second = quotes.tadbir_quotes(rows, strict=True).orderBy("url").collect()
    assert (first["creation"], first["redemption"], first["nominal"]) == (20417, 20305, 20305)
    assert first["totalNetAssetValue"] == 4100250750125
    assert first["maxUnit"] == "500,250,125" and first["navDate"] == "1402/08/30"
    assert first["date"] == datetime.datetime(2023, 11, 22, 15, 58, 12)
    assert second["date"] == datetime.datetime(2023, 11, 13)
    assert second["portfolio_id"] == "3"


def test_broken_quote(land):
    rows = land((C.TADBIR, "http://a.ir/", "", "live_navps", 1, "<html>"))
    quote = quotes.tadbir_quotes(rows).first()
    assert quote["creation"] is None and quote["date"] is None
    with pytest.raises(PySparkException, match="quote without"):
        quotes.tadbir_quotes(rows, strict=True).collect()
    bad = land((C.TADBIR, "http://a.ir/", "", "live_navps", 1, tadbir_quote(subNav="many")))
    with pytest.raises(PySparkException):
        quotes.tadbir_quotes(bad, strict=True).collect()


@pytest.mark.parametrize(
    "vendor, operator",
    [
        (C.TADBIR_LEVERAGED, quotes.leveraged_quotes),
        (C.RAYAN2, quotes.rayan_quotes),
        (C.RAYAN, quotes.rayan_quotes),
        (C.MABNA, quotes.mabna_quotes),
    ],
)
def test_strict_quotes_need_prices(land, vendor, operator):
    rows = land((vendor, "http://a.ir/", "1", "live_navps", 1, "{}"))
    assert operator(rows).first()["creation"] is None
    with pytest.raises(PySparkException, match="quote without"):
        operator(rows, strict=True).collect()


def test_leveraged_quote_and_leverage(land):
    percents = json.dumps(
        {"List": [{"x": C.TADBIR_CASH[0], "y": 22.29}, {"x": C.TADBIR_CASH[2], "y": 0.03}]}
    )
    rows = land(
        (C.TADBIR_LEVERAGED, "http://l.ir/", "", "live_navps", 1, leveraged_quote()),
        (C.TADBIR_LEVERAGED, "http://l.ir/", "", "asset_allocation", 1, percents),
    )
    quote = quotes.leveraged_quotes(rows, strict=True).first()
    assert quote["BaseUnitsCancelNAV"] == 11250.75
    assert (quote["creation"], quote["redemption"]) == (21733, 21608)
    assert quote["SuperUnitsTotalSubscription"] == 700300000
    measured = allocation.leverage(rows).first()
    cash = 22.29 / 100 + 0.0 + 0.03 / 100
    assert measured["cash"] == cash
    assert measured["leverage"] == (1 + 9000450900300 / 15132082400000) * (1 - cash)


def test_nothing_divides_by_zero(land):
    percents = json.dumps({"List": [{"x": C.TADBIR_CASH[0], "y": 10}]})
    body = json.dumps(json.dumps({"BaseUnitsTotalNetAssetValue": "۵", "SuperUnitsTotalNetAssetValue": "۰"}))
    rows = land(
        (C.TADBIR_LEVERAGED, "http://l.ir/", "", "live_navps", 1, body),
        (C.TADBIR_LEVERAGED, "http://l.ir/", "", "asset_allocation", 1, percents),
    )
    measured = allocation.leverage(rows).first()
    assert (measured["cash"], measured["leverage"]) == (0.1, None)


def test_rayan_and_mabna_quotes(land):
    new = '{"fundId":2,"purchaseNav":11015,"saleNav":10903,"date":"1404/12/09","time":"11:07:41"}'
    old = '{"FundId":1,"PurchaseNav":24803,"SaleNav":24695,"Date":"1405/02/23","Time":"17:03:07"}'
    mabna = '{"data":{"redemption_price":9748,"purchase_price":9870.5,"date_time":"2025-05-07T15:31:56+03:30"}}'
    rows = land(
        (C.RAYAN2, "http://n.ir/", "2", "live_navps", 1, new),
        (C.RAYAN, "http://o.ir/", "1", "live_navps", 1, old),
        (C.MABNA, "http://p.ir/", "1", "live_navps", 1, mabna),
        (C.TADBIR, "http://q.ir/", "", "live_navps", 1, tadbir_quote()),
        (C.TADBIR_LEVERAGED, "http://r.ir/", "", "live_navps", 1, leveraged_quote()),
    )
    one_by_one = quotes.rayan_quotes(rows).collect() + quotes.mabna_quotes(rows).collect()
    common = {r["url"]: r for r in quotes.live_quotes(rows).collect()}
    assert len(common) == 5
    for row in one_by_one:
        assert common[row["url"]]["creation"] == row["creation"]
        assert common[row["url"]]["date"] == row["date"]
    assert common["http://p.ir/"]["creation"] == 9870.5
    assert common["http://o.ir/"]["date"] == datetime.datetime(2026, 5, 13, 17, 3, 7)
    assert all(r["creation"] > r["redemption"] for r in common.values())


def chart(*series):
    return json.dumps(
        [
            {"name": str(i), "List": [{"x": x, "y": y} for x, y in s], "SecList": [], "Items": []}
            for i, s in enumerate(series)
        ]
    )


def test_empty_and_uneven_charts(land):
    empty = land((C.TADBIR, "http://a.ir/", "", "navps_history", 1, chart([], [], [])))
    assert nav.tadbir_navps(empty, strict=True).count() == 0
    assert nav.uneven_charts(empty).count() == 0
    points = [("4/8/2025", 1.0), ("4/9/2025", 2)]
    uneven = land((C.TADBIR, "http://a.ir/", "", "navps_history", 1, chart(points, points, points[:1])))
    assert nav.tadbir_navps(uneven).count() == 0
    assert nav.uneven_charts(uneven).first()["n_redemption"] == 1
    with pytest.raises(PySparkException, match="uneven"):
        nav.tadbir_navps(uneven, strict=True).collect()


def test_leveraged_chart_with_fewer_series(land):
    body = chart([("4/8/2025", 1), ("4/8/2025", 9)], [("4/9/2025", 2)], [])
    rows = land((C.TADBIR_LEVERAGED, "http://l.ir/", "", "navps_history", 1, body))
    got = nav.leveraged_navps(rows).orderBy("date").collect()
    assert [tuple(r)[3:] for r in got] == [
        (datetime.date(2025, 4, 8), 1.0, None, None, None, None, None),
        (datetime.date(2025, 4, 9), None, 2.0, None, None, None, None),
    ]


def test_all_histories_in_one_table(land):
    mabna = json.dumps(
        {
            "data": [
                {
                    "date_time": "2025-04-28T23:59:59+03:30",
                    "purchase_price": 10000,
                    "redemption_price": 9990.5,
                    "statistical_value": 9991,
                }
            ]
        }
    )
    rows = land(
        (C.TADBIR, "http://a.ir/", "", "navps_history", 1, chart([("4/8/2025", 3)], [("4/8/2025", 2)], [("4/8/2025", 1)])),
        (C.TADBIR_LEVERAGED, "http://l.ir/", "", "navps_history", 1, chart([], [], [], [("4/8/2025", 5)], [("4/8/2025", 4)])),
        (C.RAYAN, "http://r.ir/", "1", "navps_history", 1, '[{"b":"1404/1/5","a":30,"d":20.5,"c":25}]'),
        (C.MABNA, "http://m.ir/", "1", "navps_history", 1, mabna),
        (C.RAYAN2, "http://bad.ir/", "1", "navps_history", 1, "{oops"),
    )
    got = {r["url"]: tuple(r)[3:] for r in nav.navps_history(rows).collect()}
    assert got == {
        "http://a.ir/": (datetime.date(2025, 4, 8), 3.0, 1.0, 2.0),
        "http://l.ir/": (datetime.date(2025, 4, 8), 5.0, 4.0, None),
        "http://r.ir/": (datetime.date(2025, 3, 25), 30.0, 20.5, 25.0),
        "http://m.ir/": (datetime.date(2025, 4, 28), 10000.0, 9990.5, 9991.0),
    }


def test_mabna_history_keeps_all_columns(land):
    record = {"date_time": "2025-04-28T23:59:59+03:30", "total_unit_count": 5, "purchase_price": 1.5}
    rows = land((C.MABNA, "http://m.ir/", "1", "navps_history", 1, json.dumps({"data": [record]})))
    got = nav.mabna_navps(rows, strict=True)
    assert {"creation", "redemption", "statistical", "total_unit_count", "date"} <= set(got.columns)
    assert dict(got.dtypes)["date_time"] == "timestamp"
    assert got.first()["creation"] == 1.5


def wide(prefix=str, **changes):
    record = {"DepositTodayPercent": 20.21, "CashTodayPercent": 0, "BondTodayPercent": 1.15}
    record |= {"OtherStock": 78.64, "JalaliDate": "1405/03/10"} | changes
    return json.dumps({prefix(k): v for k, v in record.items() if v is not None})


def test_allocation_shapes(spark, land, tmp_path):
    listed = {"List": [{"x": "الف", "y": 1.0}, {"x": "الف", "y": 40.0}, {"x": C.TADBIR_CASH[1], "y": 60}]}
    assets = {"data": {"assets": [{"percentage": 17.99317837130175, "title": C.MABNA_CASH[1]}]}}
    rows = land(
        (C.TADBIR, "http://a.ir/", "", "asset_allocation", 1, json.dumps(listed)),
        (C.MABNA, "http://m.ir/", "1", "asset_allocation", 1, json.dumps(assets)),
        (C.RAYAN, "http://r.ir/", "1", "asset_allocation", 1, wide()),
        (C.RAYAN2, "http://s.ir/", "1", "asset_allocation", 1, wide(lambda n: n[0].lower() + n[1:])),
        (C.RAYAN, "http://t.ir/", "1", "asset_allocation", 1, wide(CashTodayPercent=None)),
        (C.MABNA, "http://bad.ir/", "1", "asset_allocation", 1, "<html>"),
    )
    long = allocation.allocation(rows).collect()
    weights = {(r["url"], r["item"]): r["weight"] for r in long}
    assert len(weights) == len(long)
    assert weights["http://a.ir/", "الف"] == 0.4
    assert weights["http://m.ir/", C.MABNA_CASH[1]] == 17.99317837130175 / 100
    assert {r["as_of"] for r in long if r["url"] == "http://r.ir/"} == {datetime.date(2026, 5, 31)}
    assert [tuple(r)[1:] for r in allocation.unknown_items(rows).collect()] == [("http://a.ir/", "", "الف")]
    maps = {r["url"]: r["weights"] for r in allocation.allocation_map(rows).collect()}
    assert maps["http://a.ir/"] == {"الف": 0.4, C.TADBIR_CASH[1]: 0.6}

    refused = land((C.MABNA, "http://no.ir/", "1", "asset_allocation", 1, "{}"), status=503)
    store_cash(rows.unionByName(refused), str(tmp_path / "cash"))
    scan = read_scan(spark, str(tmp_path / "cash"))
    cash = {r["url"]: r["cash"] for r in scan.measures.collect()}
    assert cash == {
        "http://a.ir/": 0.6,
        "http://m.ir/": 17.99317837130175 / 100,
        "http://r.ir/": 20.21 / 100 + 0.0 + 1.15 / 100,
        "http://s.ir/": 20.21 / 100 + 0.0 + 1.15 / 100,
    }
    errors = {r["url"]: r["error"] for r in scan.quarantine.collect()}
    assert errors == {
        "http://t.ir/": "cash item missing",
        "http://bad.ir/": "unreadable body",
        "http://no.ir/": "status 503",
    }
    plain = {r["url"]: r["leverage"] for r in allocation.leverage(rows).collect()}
    assert plain["http://r.ir/"] == 1 - cash["http://r.ir/"]
    assert plain["http://m.ir/"] is None


def test_home_page_facts(land):
    cells = (
        "<td>شماره ثبت نزد سازمان بورس و اوراق بهادار</td>\n\xa0 <td style=\"text-align:left\">۰۱۲۱۵۰</td>"
    )
    options = "".join(f'<option selected value="{i}">سبد {i}</option>' for i in (1, 2, 3))
    tadbir = (
        f"{C.TADBIR_MARKER}{cells} isETFMultiNavMode = true; isEtfMode=false;"
        f"{C.BASKET_HEADER}<select>{options}</select>"
        '<option value="9">x</option> version number:  9.2.2 \n rest'
    )
    rows = land(
        (C.TADBIR_MULTI, "http://a.ir/", "", "home", 1, tadbir),
        (C.RAYAN, "http://r.ir/", "1", "home", 1, "ثبت شده به شماره 12452 نزد سازمان بورس"),
        (C.MABNA, "http://m.ir/", "1", "home", 1, "12433\n نزد سازمان بورس"),
        (C.RAYAN2, "http://s.ir/", "1", "home", 1, "<title>صندوق</title>"),
    )
    facts = {r["url"]: r for r in sites.home_facts(rows).collect()}
    first = facts["http://a.ir/"]
    assert (first["isETFMultiNavMode"], first["isLeveragedMode"], first["isEtfMode"]) == (True, False, False)
    assert first["version"] == "9.2.2" and first["seo_reg_no"] == "12150"
    assert [tuple(b) for b in first["basketIDs"]] == [("1", "سبد 1"), ("2", "سبد 2"), ("3", "سبد 3")]
    assert facts["http://r.ir/"]["seo_reg_no"] == "12452"
    assert facts["http://m.ir/"]["seo_reg_no"] == "12433"
    assert facts["http://s.ir/"]["title"] == "صندوق"
    names = {(r["url"], r["portfolio_id"]): r["name"] for r in sites.portfolios(rows).collect()}
    assert names == {("http://a.ir/", "2"): "سبد 2", ("http://a.ir/", "3"): "سبد 3"}
    numbers = {r["url"]: r["site_reg_no"] for r in sites.site_reg_no(rows).collect()}
    assert numbers == {"http://a.ir/": "12150", "http://r.ir/": "12452", "http://m.ir/": "12433"}
    kinds = {r["url"]: tuple(r)[1:] for r in sites.classify(rows, ["url"]).collect()}
    assert kinds["http://a.ir/"] == (C.TADBIR_MULTI, "2")
    assert kinds["http://s.ir/"] == (None, None)


def test_page_state_and_portal_pages(spark, land):
    blob = json.dumps(json.dumps({"queries": [], "mutations": []}))
    page = (
        "old window.__REACT_QUERY_STATE__ = 1;\n"
        f"window.__REACT_QUERY_STATE__ = {blob};\nwindow.__REACT_REDUX_STATE__ = {blob};\n"
        f"window.__ENV__ = {blob}\n"
    )
    rows = land((C.MABNA, "http://m.ir/", "1", "home", 1, page))
    state = rows.select(page_state(F.col("body")).alias("s")).select("s.*").first()
    assert all(json.loads(v) == {"queries": [], "mutations": []} for v in state)
    layout = 'x; var layoutModel = {"title":"t","funds":[{"a":1},{"a":2}]}; var y = 2;'
    portal = land(("", "http://p.ir/", "", "asset_values", 1, layout))
    assert json.loads(compare.asset_values(portal).first()["record"])["title"] == "t"
    assert [r["a"] for r in compare.asset_funds(portal, "a: int").collect()] == [1, 2]


def test_landing_choices(spark, land):
    old = land((C.MABNA, "http://m.ir/", "1", "home", 1, "old"), (C.TADBIR, "http://t.ir/", None, "home", 1, "t"))
    new = land((C.MABNA, "http://m.ir/", "1", "home", 1, "new")).withColumn(
        "fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY")
    )
    kept = latest_capture(old.unionByName(new)).select("body").collect()
    assert sorted(r["body"] for r in kept) == ["new", "t"]
    ids = spark.createDataFrame(
        [(C.MABNA, None), (C.RAYAN, ""), (C.TADBIR, None), (C.TADBIR_MULTI, "3")], "s string, p string"
    ).select(portfolio_or_default(F.col("p"), F.col("s")).alias("v"))
    assert [r["v"] for r in ids.collect()] == ["1", "1", "", "3"]
    assert for_portfolio(old, "1").count() == 1
    assert for_portfolio(old, "").count() == 1
