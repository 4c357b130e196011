"""Home pages: vendor detection, facts, baskets, portfolios, site records, portal pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import text
from fundlake.operators import compare, sites
from fundlake.plans.coverage import compare_with_portal
from workloads.encode import cents, fa, landed, site_url
from workloads.registry import query

_FLAGS = "var isLeveragedMode = true;\n"
_MULTI = "var isETFMultiNavMode  =  true;"
_REG_CELLS = (
    "<td>شماره ثبت نزد سازمان بورس و اوراق بهادار</td>\n   " '<td style="text-align:left">'
)


def marked_pages(t):
    """Every page with the markers of one of eight cases, some of them with two."""
    kind = F.col("page_id") % 8
    number = (F.col("page_id") * 7 + 11000).cast("string")
    reg_cell = F.concat(F.lit(_REG_CELLS + "۰"), fa(F.col("page_id") * 7 + 11000), F.lit("</td>"))
    version = F.concat(
        F.lit("<p>version number:  9."), F.col("page_id").cast("string"), F.lit(" \n</p>")
    )
    tadbir = F.concat(F.lit(C.TADBIR_MARKER), reg_cell, version)
    added = (
        F.when(kind == 0, tadbir)
        .when(kind == 1, F.concat(tadbir, F.lit(_MULTI)))
        .when(kind == 2, F.concat(tadbir, F.lit(_FLAGS), F.lit(_MULTI)))
        .when(kind == 3, F.lit(C.RAYAN2_MARKER + C.RAYAN_MARKER))
        .when(
            kind == 4,
            F.concat(
                F.lit(C.RAYAN_MARKER + " ثبت شده به شماره "),
                number,
                F.lit(" نزد سازمان بورس و اوراق " + C.MABNA_MARKER),
            ),
        )
        .when(
            kind == 5,
            F.concat(
                F.lit(C.MABNA_MARKER + C.MABNA_API_MARKER + " "),
                fa(F.col("page_id") * 7 + 11000),
                F.lit(" نزد سازمان بورس"),
            ),
        )
        .when(kind == 6, F.lit(C.MABNA_MARKER))
        .otherwise(F.lit(""))
    )
    return t.pages.select("page_id", F.concat("html", added).alias("html"))


_KIND = """
    CASE page_id % 8 WHEN 0 THEN 'TadbirPardaz' WHEN 1 THEN 'TadbirPardazMultiNAV'
      WHEN 2 THEN 'LeveragedTadbirPardaz' WHEN 3 THEN 'RayanHamafza2' WHEN 4 THEN 'RayanHamafza'
      WHEN 5 THEN 'MabnaDP2' END
"""


@query(
    "site_classify",
    f"""
    SELECT page_id, {_KIND} AS site_type,
      CASE page_id % 8 WHEN 0 THEN '' WHEN 1 THEN '2' WHEN 2 THEN '' WHEN 3 THEN '1'
        WHEN 4 THEN '1' WHEN 5 THEN '1' END AS portfolio_id
    FROM pages
    """,
)
def site_classify(t):
    return sites.classify(marked_pages(t), ["page_id"], "html")


@query(
    "site_facts",
    f"""
    SELECT page_id, {_KIND} AS site_type,
      CASE WHEN page_id % 8 IN (0, 1, 2) THEN page_id % 8 <> 0 END AS multi,
      CASE WHEN page_id % 8 IN (0, 1, 2) THEN page_id % 8 = 2 END AS leveraged,
      CASE WHEN page_id % 8 IN (0, 1, 2) THEN '9.' || page_id END AS version,
      CASE WHEN page_id % 8 IN (0, 1, 2, 4) THEN CAST(page_id * 7 + 11000 AS VARCHAR)
        WHEN page_id % 8 = 5 THEN translate(CAST(page_id * 7 + 11000 AS VARCHAR), '0123456789', '۰۱۲۳۴۵۶۷۸۹')
        END AS reg_no,
      CASE WHEN page_id % 8 = 3 THEN regexp_extract(html, '<title>(.*?)</title>', 1, 's') END AS title
    FROM pages
    """,
)
def site_facts(t):
    pages = marked_pages(t)
    typed = pages.select(
        sites.vendor(F.col("html")).alias("site_type"),
        F.lit("http://site.example.ir/").alias("url"),
        F.col("page_id").alias("portfolio_id"),
        "html",
    )
    facts = sites.home_facts(typed, "html")
    return facts.select(
        F.col("portfolio_id").alias("page_id"),
        "site_type",
        F.col("isETFMultiNavMode").alias("multi"),
        F.col("isLeveragedMode").alias("leveraged"),
        "version",
        F.col("seo_reg_no").alias("reg_no"),
        "title",
    )


@query(
    "versions_by_vendor",
    f"""
    SELECT DISTINCT {_KIND} AS site_type, '9.' || page_id AS version
    FROM pages WHERE page_id % 8 IN (0, 1, 2)
    """,
)
def versions_by_vendor(t):
    typed = marked_pages(t).withColumn("vendor", sites.vendor(F.col("html")))
    rows = landed(typed, F.col("vendor"), site_url("v", "page_id"), "home", F.col("html"))
    return sites.versions(rows)


@query(
    "baskets",
    """
    SELECT s_suppkey, CAST(k AS VARCHAR) AS portfolio_id, 'basket ' || s_name || ' ' || k AS name
    FROM supplier, range(1, 5) r(k)
    WHERE s_suppkey % 2 = 1 AND k > 1
    UNION ALL SELECT s_suppkey, '1', 'http://b' || s_suppkey || '.example.ir/' FROM supplier
    WHERE s_suppkey % 2 = 0
    """,
)
def baskets(t):
    """Suppliers as sites; odd ones list four baskets, of which the first is left out."""
    options = F.concat(
        *[
            F.concat(
                F.lit(f'<option class="o" value="{k}">basket '), F.col("s_name"), F.lit(f" {k}</option>\n")
            )
            for k in range(1, 5)
        ]
    )
    listed = F.concat(
        F.lit(C.TADBIR_MARKER + _MULTI + '<option value="9">outside</option>' + C.BASKET_HEADER + "<select>"),
        options,
        F.lit('</select><option value="8">outside</option>'),
    )
    body = F.when(F.col("s_suppkey") % 2 == 1, listed).otherwise(F.lit(C.TADBIR_MARKER))
    rows = landed(t.supplier, C.TADBIR, site_url("b", "s_suppkey"), "home", body)
    return sites.portfolios(rows).select(
        F.regexp_extract("url", r"b(\d+)", 1).cast("bigint").alias("s_suppkey"),
        "portfolio_id",
        "name",
    )


def record_pages(t):
    """Site records of three vendors for every customer."""
    key, name = F.col("c_custkey"), F.col("c_name")
    customers = t.customer
    items = F.to_json(
        F.array(
            F.struct(
                key.alias("fundId"),
                name.alias("fundName"),
                F.lit(True).alias("isDefaultFund"),
                (key % 2 == 0).alias("isETF"),
            )
        )
    )
    data = F.to_json(
        F.struct(
            (key % 5 + 1).alias("FundType"),
            F.array(F.struct(key.alias("FundId"), name.alias("FundName"))).alias("FundList"),
        )
    )
    mabna = F.to_json(
        F.struct(F.array(F.struct(key.cast("string").alias("id"), name.alias("name"))).alias("data"))
    )
    info = F.to_json(
        F.struct(
            (key + 10000).cast("string").alias("dsCode"),
            (key % 5 + 1).alias("fundType"),
            name.alias("fundName"),
        )
    )
    url = site_url("r", "c_custkey")
    parts = [
        (C.RAYAN2, "fund_items", items),
        (C.RAYAN, "fund_data", data),
        (C.MABNA, "portfolios", mabna),
        (C.RAYAN2, "site_info", info),
    ]
    pages = [landed(customers, vendor, url, endpoint, body) for vendor, endpoint, body in parts]
    return pages[0].unionByName(pages[1]).unionByName(pages[2]).unionByName(pages[3])


@query(
    "fund_items",
    """
    SELECT site_type, 'http://r' || c_custkey || '.example.ir/' AS url,
      CAST(c_custkey AS VARCHAR) AS portfolio_id, c_name AS name
    FROM customer, (VALUES ('RayanHamafza2'), ('RayanHamafza'), ('MabnaDP2')) v(site_type)
    """,
)
def fund_items(t):
    return sites.portfolios(record_pages(t))


@query(
    "site_records",
    """
    SELECT CAST(c_custkey + 10000 AS VARCHAR) AS reg_no, c_name AS fund_name, c_custkey AS fund_id,
      c_custkey % 2 = 0 AS is_etf,
      CASE c_custkey % 5 WHEN 0 THEN 'SIMPLE' WHEN 1 THEN 'SIMPLE_ETF' WHEN 2 THEN 'HYBRID'
        WHEN 3 THEN 'MULTI_FUND' ELSE 'MULTI_ETF' END AS kind
    FROM customer
    """,
)
def site_records(t):
    pages = record_pages(t)
    info = sites.site_info(pages).select(
        "url", F.col("dsCode").alias("reg_no"), F.col("fundTypeLabel").alias("kind")
    )
    items = sites.fund_items(pages).select(
        "url",
        F.col("fundId").cast("bigint").alias("fund_id"),
        F.col("fundName").alias("fund_name"),
        F.col("isETF").alias("is_etf"),
    )
    return info.join(items, "url").drop("url")


@query(
    "short_name_join",
    """
    SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN 'S' || p_partkey END AS short_name FROM part
    """,
)
def short_name_join(t):
    portal = portal_pages(t)
    listed = compare.portal_list(portal)
    named = compare.with_short_names(listed, compare.asset_specifications(portal))
    return named.select(F.col("asset_id").cast("bigint").alias("p_partkey"), "short_name")


def portal_pages(t):
    """Portal list and specifications of all parts; every seventh part has no instrument."""
    key = F.col("p_partkey")
    rows = t.part
    entry = F.struct(key.cast("string").alias("asset_id"), F.col("p_name").alias("name"))
    listed = F.to_json(F.struct(F.array(entry).alias("data")))
    names = F.array(
        F.struct(F.concat(F.lit("S"), key.cast("string")).alias("short_name")),
        F.struct(F.lit("second").alias("short_name")),
    )
    none = F.array().cast(names_type())
    spec = F.to_json(
        F.struct(
            F.struct(
                key.cast("string").alias("asset_id"),
                F.col("p_name").alias("name"),
                F.when(key % 7 == 0, none).otherwise(names).alias("instruments"),
            ).alias("data")
        )
    )
    page = F.concat(
        F.lit("<script>var layoutModel = "),
        F.to_json(
            F.struct(
                F.col("p_name").alias("title"),
                F.array(
                    F.struct(key.alias("fund_id"), cents("p_retailprice").alias("worth")),
                    F.struct((key + 1).alias("fund_id"), F.lit(0).cast("bigint").alias("worth")),
                ).alias("funds"),
            )
        ),
        F.lit("; var other = 1;</script>"),
    )
    url = F.lit("http://portal.example.com/")
    return (
        landed(rows, "", url, "etf_list", listed)
        .unionByName(landed(rows, "", url, "asset_spec", spec))
        .unionByName(landed(rows, "", url, "asset_values", page))
    )


def names_type() -> str:
    return "array<struct<short_name: string>>"


@query(
    "portal_gap",
    "SELECT 'S' || p_partkey AS short_name FROM part WHERE p_partkey % 7 <> 0 AND p_size > 25 "
    "UNION ALL SELECT NULL FROM part WHERE p_partkey % 7 = 0",
)
def portal_gap(t):
    """Portal funds without a catalogue symbol; a fund without a short name stays."""
    symbol = F.concat(F.lit("S"), F.col("p_partkey").cast("string"))
    catalog = t.part.select(F.when(F.col("p_size") <= 25, symbol).alias("l18"))
    return compare_with_portal(portal_pages(t), catalog)


@query(
    "portal_asset_funds",
    """
    SELECT p_partkey AS fund_id, CAST(round(p_retailprice * 100) AS BIGINT) AS worth FROM part
    UNION ALL SELECT p_partkey + 1, 0 FROM part
    """,
)
def portal_asset_funds(t):
    funds = compare.asset_funds(portal_pages(t), "fund_id: bigint, worth: bigint")
    return funds.select("fund_id", "worth")
