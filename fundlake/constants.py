"""Values fixed by the data itself: vendor names, labels, markers and key lists."""

# Vendor classes of fund sites, as stored in the catalogue.
TADBIR = "TadbirPardaz"
TADBIR_MULTI = "TadbirPardazMultiNAV"
TADBIR_LEVERAGED = "LeveragedTadbirPardaz"
RAYAN = "RayanHamafza"
RAYAN2 = "RayanHamafza2"
MABNA = "MabnaDP2"

TADBIR_FAMILY = [TADBIR, TADBIR_MULTI, TADBIR_LEVERAGED]
RAYAN_FAMILY = [RAYAN, RAYAN2]

# Order in which vendors are tried when a page cannot be classified.
TRIAL_ORDER = [RAYAN2, TADBIR, TADBIR_LEVERAGED, MABNA]

# Portfolio used when the catalogue names none.
DEFAULT_PORTFOLIO = {RAYAN: "1", RAYAN2: "1", MABNA: "1"}

# Registry fund-type codes and their labels.
FUND_TYPE_LABELS = {
    4: "Fixed",
    5: "Commodity",
    6: "Stock",
    7: "Mixed",
    17: "FOF",
    18: "REIT",
    21: "Sector",
    22: "Leveraged",
    23: "Index",
    24: "Guarantee",
}

# Registry fund types that are not exchange-traded.
EXCLUDED_FUND_TYPES = [11, 12, 13, 14, 16]

# Site fund types of one vendor.
SITE_FUND_TYPES = {1: "SIMPLE", 2: "SIMPLE_ETF", 3: "HYBRID", 4: "MULTI_FUND", 5: "MULTI_ETF"}

# Instrument descriptions that the coverage comparison ignores.
IGNORED_DESCRIPTIONS = [
    "نوع صندوق : خصوصی",
    "نوع صندوق :  جسورانه",
    "نوع صندوق:  جسورانه",
]

# Asset-allocation items each vendor is known to send.
TADBIR_ITEMS = [
    "اختیار معامله",
    "اوراق گواهی سپرده",
    "اوراق مشارکت",
    "پنج سهم برتر",
    "سایر دارایی‌ها",
    "سایر سهام",
    "سایر سهم‌ها",
    "سهم‌های برتر",
    "شمش و طلا",
    "صندوق سرمایه‌گذاری در سهام",
    "صندوق های سرمایه گذاری",
    "گواهی سپرده کالایی",
    "نقد و بانک (جاری)",
    "نقد و بانک (سپرده)",
]
MABNA_ITEMS = [
    "اوراق",
    "پنج سهم با بیشترین وزن",
    "سایر",
    "سایر دارایی ها",
    "سایر دارایی‌ها",
    "سایر سهام",
    "سپرده بانکی",
    "سهام",
    "وجه نقد",
]
RAYAN_ITEMS = [
    "BondTodayPercent",
    "CashTodayPercent",
    "CcdTodayPercent",
    "DepositTodayPercent",
    "JalaliDate",
    "OtherAssetTodayPercent",
    "OtherStock",
    "TopFiveStockTodayPercent",
]
RAYAN2_ITEMS = [name[0].lower() + name[1:] for name in RAYAN_ITEMS]

# Items that count as cash. The sum runs in this order.
TADBIR_CASH = ["نقد و بانک (سپرده)", "نقد و بانک (جاری)", "اوراق مشارکت"]
MABNA_CASH = ["اوراق", "وجه نقد", "سپرده بانکی"]
RAYAN_CASH = ["DepositTodayPercent", "CashTodayPercent", "BondTodayPercent"]
RAYAN2_CASH = [name[0].lower() + name[1:] for name in RAYAN_CASH]

# Columns of the 21-column net-asset-value report, in page order.
NAV_REPORT_COLUMNS = [
    "Row",
    "Date",
    "Issue Price",
    "Redemption Price",
    "Statistical Price",
    "NAV of Premium Units Issued",
    "NAV of Premium Units Redeemed",
    "Statistical NAV of Premium Units",
    "NAV of Normal Units",
    "Net Asset Value of Fund",
    "Net Asset Value of Premium Units",
    "Net Asset Value of Normal Units",
    "Number of Premium Units Issued",
    "Number of Premium Units Redeemed",
    "Number of Normal Units Issued",
    "Number of Normal Units Redeemed",
    "Remaining Premium Certificate",
    "Remaining Normal Certificate",
    "Total Fund Units",
    "Leverage Ratio",
    "Number of Normal Unit Investors",
]

# Columns of the dividend report, in page order.
DIVIDEND_COLUMNS = ["row", "date", "fundUnit", "unitProfit", "sumAllProfit", "profitPercent"]

# Series of a leveraged fund's chart, in payload order.
LEVERAGED_SERIES = [
    "normal_creation",
    "normal_statistical",
    "normal_redemption",
    "creation",
    "redemption",
    "normal",
]

# Markers that identify a vendor's home page.
TADBIR_MARKER = '<div class="tadbirLogo"></div>'
RAYAN2_MARKER = "<!-- Rayanhamafza Front-End Team -->"
RAYAN_MARKER = "Rayan Ham Afza"
MABNA_MARKER = "://mabnadp.com"
MABNA_API_MARKER = "/api/v2"

# Phrases and patterns around facts on a home page.
BASKET_HEADER = '<div class="drp-basket-header">'
BASKET_OPTION = r'(?U)<option [^>]*?value="(\d+)">([^<]*)</option>'
VERSION_PHRASE = "version number:"
TADBIR_REG_NO = (
    r"(?U)<td>شماره ثبت نزد سازمان بورس و اوراق بهادار</td>\s*"
    r'<td style="text-align:left">(.*?)</td>'
)
MABNA_REG_NO = r"(?U)(\d+)\s*نزد سازمان بورس"
RAYAN_REG_NO = r"(?U)ثبت شده به شماره (\d+) نزد سازمان بورس"

# Text around paging links and script state.
NEXT_PAGE_TITLE = '" title="Next page">'
QUERY_STATE = "window.__REACT_QUERY_STATE__ = "
REDUX_STATE = "window.__REACT_REDUX_STATE__ = "
ENV_STATE = "window.__ENV__ = "
LAYOUT_MODEL = "var layoutModel = "
