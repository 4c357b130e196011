"""Sites: vendor detection, facts on home pages, portfolios and site records.

All of it is one projection per landed page; the page text never crosses a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake import schemas as S
from fundlake.functions import text
from fundlake.functions.rows import exploded, inlined, keep_where
from fundlake.operators import quotes
from fundlake.sources.landing import captured
from fundlake.sources.payload import from_json, page_state, read_records


def flag(html: Column, name: str) -> Column:
    """Whether a page script sets the variable to true."""
    return html.rlike(rf"(?U){name}\s*=\s*true;")


def vendor(html: Column) -> Column:
    """Vendor class of a home page by its markers; null when no marker fits."""
    tadbir = (
        F.when(flag(html, "isLeveragedMode"), F.lit(C.TADBIR_LEVERAGED))
        .when(flag(html, "isETFMultiNavMode"), F.lit(C.TADBIR_MULTI))
        .otherwise(F.lit(C.TADBIR))
    )
    return (
        F.when(html.contains(C.TADBIR_MARKER), tadbir)
        .when(html.contains(C.RAYAN2_MARKER), F.lit(C.RAYAN2))
        .when(html.contains(C.RAYAN_MARKER), F.lit(C.RAYAN))
        .when(
            html.contains(C.MABNA_MARKER),
            F.when(html.contains(C.MABNA_API_MARKER), F.lit(C.MABNA)),
        )
    )


def initial_portfolio(site_type: Column) -> Column:
    """Portfolio of a freshly detected site."""
    return (
        F.when(site_type == C.TADBIR_MULTI, "2")
        .when(site_type.isin(*C.DEFAULT_PORTFOLIO), "1")
        .when(site_type.isNotNull(), "")
    )


def classify(pages: DataFrame, keep: list[str], html: str = "body") -> DataFrame:
    """Pages -> ``(keep…, site_type, portfolio_id)`` by the markers in the page."""
    detected = pages.select(*keep, vendor(F.col(html)).alias("site_type"))
    return detected.select(
        *keep, "site_type", initial_portfolio(F.col("site_type")).alias("portfolio_id")
    )


def version(html: Column) -> Column:
    """Text behind the version phrase up to the end of its line; null without the phrase."""
    line = text.before_first(text.after_first(html, C.VERSION_PHRASE), "\n")
    return F.when(html.contains(C.VERSION_PHRASE), text.strip(line))


def title(html: Column) -> Column:
    return text.before_first(text.after_first(html, "<title>"), "</title>")


def baskets(html: Column) -> Column:
    """Options of the basket list -> array of ``(portfolio_id, name)``."""
    options = text.before_first(text.after_first(html, C.BASKET_HEADER), "</select>")
    ids = F.regexp_extract_all(options, F.lit(C.BASKET_OPTION), F.lit(1))
    names = F.regexp_extract_all(options, F.lit(C.BASKET_OPTION), F.lit(2))
    return F.arrays_zip(ids.alias("portfolio_id"), names.alias("name"))


def _found(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def page_reg_no(site_type: Column, html: Column) -> Column:
    """Registration number as the vendor prints it; one vendor's is an integer."""
    tadbir = _found(F.regexp_extract(html, C.TADBIR_REG_NO, 1))
    return (
        F.when(
            site_type.isin(*C.TADBIR_FAMILY),
            text.to_whole(tadbir, strict=False).cast("string"),
        )
        .when(site_type == C.RAYAN, _found(F.regexp_extract(html, C.RAYAN_REG_NO, 1)))
        .when(site_type == C.MABNA, _found(F.regexp_extract(html, C.MABNA_REG_NO, 1)))
    )


def home_facts(pages: DataFrame, html: str = "body") -> DataFrame:
    """Facts of every home page in one projection; columns a vendor lacks are null."""
    site_type, page = F.col("site_type"), F.col(html)
    is_tadbir = site_type.isin(*C.TADBIR_FAMILY)
    multi = flag(page, "isETFMultiNavMode")
    return pages.select(
        *S.KEY,
        F.when(is_tadbir, multi).alias("isETFMultiNavMode"),
        F.when(is_tadbir, flag(page, "isLeveragedMode")).alias("isLeveragedMode"),
        F.when(is_tadbir, flag(page, "isEtfMode")).alias("isEtfMode"),
        F.when(is_tadbir & multi, baskets(page)).alias("basketIDs"),
        F.when(is_tadbir, version(page)).alias("version"),
        page_reg_no(site_type, page).alias("seo_reg_no"),
        F.when(site_type == C.RAYAN2, title(page)).alias("title"),
    )


def home_states(responses: DataFrame) -> DataFrame:
    """Script state of the home pages of one vendor, as JSON text per blob."""
    rows = captured(responses, "home", [C.MABNA])
    return rows.select("site_type", "url", page_state(F.col("body")).alias("s")).select(
        "site_type", "url", "s.*"
    )


def fund_type_label(code: Column) -> Column:
    labels = F.create_map(*[F.lit(v) for pair in C.SITE_FUND_TYPES.items() for v in pair])
    return F.try_element_at(labels, code)


def site_info(responses: DataFrame) -> DataFrame:
    """Site record of one vendor, with the fund type's label; ``dsCode`` is its reg. number."""
    rows = captured(responses, "site_info", [C.RAYAN2])
    info = rows.select(*S.KEY, from_json(F.col("body"), S.SITE_INFO).alias("i")).select(
        *S.KEY, "i.*"
    )
    return info.withColumn("fundTypeLabel", fund_type_label(F.col("fundType")))


def fund_items(responses: DataFrame) -> DataFrame:
    rows = captured(responses, "fund_items", [C.RAYAN2])
    return read_records(rows, S.FUND_ITEMS, S.KEY).drop("pos")


def fund_data(responses: DataFrame) -> DataFrame:
    """Fund list of the older vendor, one row per fund, with the site's fund type."""
    rows = captured(responses, "fund_data", [C.RAYAN])
    data = rows.select(*S.KEY, from_json(F.col("body"), S.FUND_DATA).alias("d"))
    kind = F.col("d.FundType")
    keep = [*S.KEY, kind.alias("FundType"), fund_type_label(kind).alias("FundTypeLabel")]
    funds = exploded(data, keep, F.col("d.FundList"), "f")
    return funds.select(*S.KEY, "FundType", "FundTypeLabel", "f.*")


_SITE_ENDPOINTS = ["home", "site_info", "portfolios", "fund_items", "fund_data"]


def site_summary(responses: DataFrame) -> DataFrame:
    """What the responses of a site tell, one small row per response.

    ``detected`` is the vendor of a home page, ``site_reg_no`` the registration number of a
    page or site record, ``portfolios`` the listed ``(portfolio_id, name)``. A multi-basket
    site lists its baskets but the first; any other site of that vendor is its own
    portfolio ``1``, named by its URL.
    """
    site_type, body, endpoint = F.col("site_type"), F.col("body"), F.col("endpoint")
    is_home = endpoint == "home"
    rows = responses.filter(
        F.col("status").between(200, 299) & endpoint.isin(*_SITE_ENDPOINTS)
    )
    entry = "array<struct<portfolio_id: string, name: string>>"

    def listed(records, id_name, name):
        return F.transform(records, lambda r: F.struct(r[id_name].cast("string"), r[name])).cast(
            entry
        )

    options = F.filter(baskets(body), lambda b: b["portfolio_id"] != "1").cast(entry)
    single = F.array(F.struct(F.lit("1"), F.col("url"))).cast(entry)
    found = (
        F.when(
            site_type.isin(*C.TADBIR_FAMILY) & is_home,
            F.when(flag(body, "isETFMultiNavMode"), options).otherwise(single),
        )
        .when(
            (site_type == C.MABNA) & (endpoint == "portfolios"),
            listed(from_json(body, S.MABNA_PORTFOLIOS)["data"], "id", "name"),
        )
        .when(
            (site_type == C.RAYAN2) & (endpoint == "fund_items"),
            listed(from_json(body, S.FUND_ITEMS), "fundId", "fundName"),
        )
        .when(
            (site_type == C.RAYAN) & (endpoint == "fund_data"),
            listed(from_json(body, S.FUND_DATA)["FundList"], "FundId", "FundName"),
        )
    )
    number = F.when(
        (site_type == C.RAYAN2) & (endpoint == "site_info"), from_json(body, S.SITE_INFO)["dsCode"]
    ).when(is_home, page_reg_no(site_type, body))
    return rows.select(
        "site_type",
        "url",
        "endpoint",
        "fetched_at",
        F.when(is_home, vendor(body)).alias("detected"),
        number.alias("site_reg_no"),
        found.alias("portfolios"),
    )


def summary_detected(summary: DataFrame) -> DataFrame:
    """``(url, site_type)`` of the newest home page per URL; null where no vendor fits it."""
    homes = summary.filter(F.col("endpoint") == "home")
    return homes.groupBy("url").agg(F.max_by("detected", "fetched_at").alias("site_type"))


def summary_reg_no(summary: DataFrame) -> DataFrame:
    """Registration number per site from its newest page or site record; null if missing."""
    source = F.when(F.col("site_type") == C.RAYAN2, "site_info").otherwise("home")
    rows = summary.filter(F.col("endpoint") == source)
    return rows.groupBy("site_type", "url").agg(
        F.max_by("site_reg_no", "fetched_at").alias("site_reg_no")
    )


def _newest_lists(summary: DataFrame) -> DataFrame:
    lists = summary.filter(F.col("portfolios").isNotNull())
    return lists.groupBy("site_type", "url").agg(F.max_by("portfolios", "fetched_at").alias("portfolios"))


def summary_portfolios(summary: DataFrame) -> DataFrame:
    """Portfolios of the newest list per site."""
    return inlined(_newest_lists(summary), ["site_type", "url"], F.col("portfolios"))


def summary_listed(summary: DataFrame) -> DataFrame:
    """URLs that answered with a list, an empty one included."""
    return summary.filter(F.col("portfolios").isNotNull()).select("url").distinct()


def site_reg_no(responses: DataFrame) -> DataFrame:
    """``(site_type, url, site_reg_no)`` of every site."""
    return summary_reg_no(site_summary(responses))


def portfolios(responses: DataFrame) -> DataFrame:
    """``(site_type, url, portfolio_id, name)`` of every site, in one scan."""
    return summary_portfolios(site_summary(responses))


def vendor_by_trial(responses: DataFrame) -> DataFrame:
    """``(domain, url, site_type)``: the first vendor, in trial order, whose newest quote parses.

    A trial is a landed quote whose ``site_type`` says how it was asked for. An answer that
    parsed once does not count after a newer one of the same trial that does not. Trials are
    reduced by maxima of small structs, so repeats shrink before the shuffle.
    """
    rows = captured(responses, quotes.ENDPOINT, C.TRIAL_ORDER)
    parsed = quotes.live_quotes(rows)
    outcome = F.struct("fetched_at", quotes.is_complete(parsed).alias("complete"), text.url_base(F.col("url")).alias("url"))
    keyed = parsed.select(text.url_domain(F.col("url")).alias("domain"), "site_type", outcome.alias("outcome"))
    newest = keyed.groupBy("domain", "site_type").agg(F.max("outcome").alias("newest"))
    priority = F.lit(None).cast("int")
    for i, name in enumerate(C.TRIAL_ORDER):
        priority = F.when(F.col("site_type") == name, F.lit(i)).otherwise(priority)
    read = newest.filter("newest.complete").select("domain", F.struct(priority.alias("priority"), "newest.url", "site_type").alias("found"))
    best = read.groupBy("domain").agg(F.min("found").alias("best"))
    return best.select("domain", "best.url", "best.site_type")


def probed_sites(responses: DataFrame) -> DataFrame:
    """``(domain, url, site_type)`` of every landed site, the input of a catalogue update.

    The newest home page of a domain decides if it carries a vendor's markers, whatever older
    pages carried; without markers the first vendor whose newest quote parses does.
    """
    pages = classify(captured(responses, "home"), ["url", "fetched_at"])
    seen = F.struct("fetched_at", "site_type", text.url_base(F.col("url")).alias("url"))
    keyed = pages.select(text.url_domain(F.col("url")).alias("domain"), seen.alias("seen"))
    newest = keyed.groupBy("domain").agg(F.max("seen").alias("seen"))
    marked = newest.filter("seen.site_type IS NOT NULL").select("domain", F.struct(F.lit(0).alias("priority"), "seen.url", "seen.site_type").alias("found"))
    tried = vendor_by_trial(responses).select("domain", F.struct(F.lit(1).alias("priority"), "url", "site_type").alias("found"))
    best = marked.unionByName(tried).groupBy("domain").agg(F.min("found").alias("best"))
    return best.select("domain", "best.url", "best.site_type")


def versions(responses: DataFrame) -> DataFrame:
    """Distinct ``(site_type, version)``; pages that name no version are left out.

    Kept as rows: a vendor may have any number of versions, and rows never gather in one task.
    """
    rows = captured(responses, "home").filter(F.col("site_type") != C.RAYAN)
    found = rows.select("site_type", version(F.col("body")).alias("version")).distinct()
    return found.filter(F.col("version").isNotNull())
