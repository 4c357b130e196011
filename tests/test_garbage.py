"""No response body, however broken, fails a lenient job."""

import itertools

import pytest

from fundlake import constants as C
from fundlake.operators import allocation, compare, dividends, nav, quotes, sites
from fundlake.plans.scan_funds import scan_cash
from fundlake.sources.landing import incomplete_reports, latest_capture

BODIES = [
    None,
    "",
    " ",
    "null",
    "{}",
    "[]",
    "[null]",
    "[[1]]",
    "[[null, null, null]]",
    '"x"',
    '"{"',
    '"{\\"subNav\\":null,\\"publishDate\\":\\"1/2\\"}"',
    '{"data":null}',
    '{"data":{"assets":[null],"date_time":"never","purchase_price":"many"}}',
    '{"data":[{"date_time":"2025-99-99"}, null]}',
    '{"List":[{"x":null,"y":null}, null, {"x":"a","y":"text"}]}',
    '[{"List":null},{"List":[]},{"List":[{"x":"1/1/2025","y":1}]}]',
    '[{"List":[{"x":"13/45/2025","y":1e400}]},{},{}]',
    '[{"a":"1402/13/40","b":"x"}]',
    '{"DepositTodayPercent":"x","CashTodayPercent":null,"BondTodayPercent":1e999}',
    "<tbody><tr><td>x</td></tr><tr></tr></tbody>",
    "<tbody><tr>" + "<td>۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹۹</td>" * 30 + "</tr>",
    "</tbody><tbody>",
    C.TADBIR_MARKER + "isETFMultiNavMode=true;" + C.BASKET_HEADER,
    C.QUERY_STATE + '"{\\"queries\\":[{\\"state\\":null},{\\"state\\":{\\"data\\":3}}]}";\n',
    C.REDUX_STATE + "not json;\n" + C.QUERY_STATE + "1;\n",
    "var layoutModel = {;",
    "\u0000￾\U0001f600",
]
VENDORS = [*C.TADBIR_FAMILY, *C.RAYAN_FAMILY, C.MABNA, "", None]
ENDPOINTS = (
    "home live_navps navps_history nav_history assets_history industries asset_allocation "
    "dividend_history portfolios site_info fund_items fund_data etf_list asset_spec asset_values"
).split()


@pytest.fixture(scope="module")
def garbage(land):
    combinations = itertools.product(VENDORS, ENDPOINTS, enumerate(BODIES))
    rows = [
        (vendor, None if i % 5 == 0 else f"http://h{i}/", str(i), endpoint, i, body)
        for vendor, endpoint, (i, body) in combinations
    ]
    return land(*rows).cache()


@pytest.mark.parametrize(
    "operator",
    [
        quotes.live_quotes,
        quotes.tadbir_quotes,
        quotes.leveraged_quotes,
        quotes.rayan_quotes,
        quotes.mabna_quotes,
        nav.navps_history,
        nav.tadbir_navps,
        nav.uneven_charts,
        nav.leveraged_navps,
        nav.rayan_navps,
        nav.mabna_navps,
        nav.mabna_assets,
        nav.nav_report,
        nav.rayan_daily_nav,
        dividends.report_dividends,
        dividends.json_dividends,
        allocation.allocation,
        allocation.allocation_map,
        allocation.unknown_items,
        allocation.weight_violations,
        allocation.industries,
        allocation.leverage,
        scan_cash,
        sites.home_states,
        sites.site_info,
        sites.fund_items,
        sites.fund_data,
        sites.site_summary,
        sites.portfolios,
        sites.site_reg_no,
        sites.vendor_by_trial,
        sites.probed_sites,
        sites.versions,
        compare.portal_list,
        compare.asset_specifications,
        compare.asset_values,
        incomplete_reports,
        latest_capture,
    ],
)
def test_operator_survives(garbage, operator):
    operator(garbage).write.format("noop").mode("overwrite").save()


def test_home_facts_survive(garbage):
    sites.home_facts(garbage).write.format("noop").mode("overwrite").save()


def test_every_cash_response_has_an_outcome(garbage):
    asked = garbage.filter("endpoint = 'asset_allocation'").count()
    assert scan_cash(garbage).count() == asked
