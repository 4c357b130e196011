"""Declared schemas: landing table, catalogue and vendor payloads (nothing is inferred)."""

from __future__ import annotations

# A fund is one portfolio of one site.
KEY = ["site_type", "url", "portfolio_id"]

RESPONSES = (
    "site_type string, url string, portfolio_id string, endpoint string, page int, "
    "status int, fetched_at timestamp, body string"
)

CATALOG_COLUMNS = [
    "l18",
    "name",
    "type",
    "ins_code",
    "reg_no",
    "url",
    "portfolio_id",
    "site_type",
    "dps_interval",
    "group_id",
]
CATALOG = (
    "l18 string, name string, type string, ins_code string, reg_no string, url string, "
    "portfolio_id string, site_type string, dps_interval tinyint, group_id tinyint"
)

REGISTRY = (
    "regNo string, insCode string, groupId int, typeOfInvest string, fundType int, "
    "isCompleted boolean, smallSymbolName string, name string, websiteAddress string, "
    "dividendIntervalPeriod int"
)

# Live quotes. Numbers of the first two arrive as text.
TADBIR_QUOTE_WHOLE = {
    "dailyTotalNetAssetValue": "dailyTotalNetAssetValue",
    "dailyTotalUnit": "dailyTotalUnit",
    "finalCancelNAV": "finalCancelNAV",
    "finalEsmiNAV": "finalEsmiNAV",
    "finalSubscriptionNAV": "finalSubscriptionNAV",
    "totalNetAssetValue": "totalNetAssetValue",
    "totalUnit": "totalUnit",
    "subNav": "creation",
    "cancelNav": "redemption",
    "esmiNav": "nominal",
}
TADBIR_QUOTE_TEXT = ["maxUnit", "navDate"]
TADBIR_QUOTE = ", ".join(
    f"{name} string" for name in [*TADBIR_QUOTE_WHOLE, *TADBIR_QUOTE_TEXT, "publishDate"]
)

LEVERAGED_QUOTE_DOUBLE = [
    "BaseUnitsCancelNAV",
    "BaseUnitsTotalNetAssetValue",
    "SuperUnitsTotalNetAssetValue",
]
LEVERAGED_QUOTE_WHOLE = {
    "SuperUnitsSubscriptionNAV": "creation",
    "SuperUnitsCancelNAV": "redemption",
    "BaseUnitsTotalSubscription": "BaseUnitsTotalSubscription",
    "SuperUnitsTotalSubscription": "SuperUnitsTotalSubscription",
}
LEVERAGED_QUOTE = ", ".join(
    f"{name} string"
    for name in [*LEVERAGED_QUOTE_DOUBLE, *LEVERAGED_QUOTE_WHOLE, "PublishDate"]
)

RAYAN2_QUOTE = (
    "nextTimeInterval bigint, fundId bigint, fundNavId bigint, purchaseNav double, "
    "saleNav double, date string, time string, valueDivisionRemain bigint"
)
RAYAN_QUOTE = (
    "NextTimeInterval bigint, FundId bigint, FundNavId bigint, PurchaseNav double, "
    "SaleNav double, Date string, Time string"
)
MABNA_QUOTE = (
    "data struct<redemption_price: double, purchase_price: double, date_time: string>"
)

# Histories.
TADBIR_CHART = "array<struct<name: string, List: array<struct<x: string, y: double>>>>"
MABNA_CHART = (
    "data array<struct<date_time: string, total_unit_count: bigint, purchase_price: double, "
    "redemption_price: double, common_unit_purchase_price: double, "
    "today_purchase_count: bigint, today_redeemed_count: bigint, "
    "total_purchase_count: bigint, total_redeemed_count: bigint, "
    "total_preferred_unit_count: bigint, total_common_unit_count: bigint, "
    "statistical_value: double>>"
)
MABNA_ASSETS_CHART = "data array<struct<date_time: string, value: bigint>>"
RAYAN_POSITIONAL = "array<map<string, string>>"
RAYAN_DAILY = "array<array<string>>"

# Dividends of the JSON vendors.
DIVIDEND_JSON_WHOLE = [
    "fundId",
    "fundUnit",
    "profitGuaranteeUnit",
    "unitProfit",
    "extraProfit",
    "sumUnitProfit",
    "sumExtraProfit",
    "sumProfitGuarantee",
    "sumAllProfit",
]


def dividend_json(rename=lambda name: name) -> str:
    fields = [f"{rename(name)}: bigint" for name in DIVIDEND_JSON_WHOLE]
    return f"array<struct<{', '.join([*fields, rename('profitDate') + ': string'])}>>"


# Allocation.
TADBIR_ALLOCATION = "List array<struct<x: string, y: double, name: string>>"
MABNA_ALLOCATION = (
    "data struct<assets: array<struct<percentage: double, title: string>>, "
    "industries: array<struct<percentage: double, title: string>>>"
)

# Portfolios and site records.
MABNA_PORTFOLIOS = "data array<struct<id: string, name: string>>"
SITE_INFO = (
    "dsCode string, fundCode string, submitCode string, fundType int, defaultFundId int, "
    "fundName string, fundAbbreviation string, webSiteUrl string"
)
FUND_ITEMS = (
    "array<struct<fundId: int, fundName: string, isDefaultFund: boolean, isETF: boolean, "
    "logoUrl: string, tsetmcUrl: string>>"
)
FUND_DATA = (
    "FundType int, "
    "FundList array<struct<FundId: int, FundName: string, IsDefaultFund: boolean>>"
)

# Asset portal.
ETF_LIST = "data array<struct<asset_id: string, name: string>>"
ASSET_SPECIFICATION = (
    "data struct<asset_id: string, name: string, "
    "instruments: array<struct<short_name: string>>>"
)
