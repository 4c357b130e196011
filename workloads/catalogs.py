"""Catalogue: reconciliation with feeds, quality rules, coverage, storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.operators import compare, quality, reconcile
from fundlake.plans.check_catalog import check_live, check_static
from fundlake.plans.coverage import compare_with_exchange, count_missing
from fundlake.plans.fill_catalog import fill_reg_numbers, set_payout_intervals
from fundlake.plans.update_catalog import update_catalog
from fundlake.schemas import CATALOG
from fundlake.session import shared_folder
from fundlake.sources.landing import for_portfolio, latest_capture
from fundlake.sources.tables import catalog_positions, scan_catalog_csv, sink_catalog_csv, with_site
from workloads.encode import landed
from workloads.registry import ORACLES, query

#: Buckets of the stored lookups here, and the share of rows from which on a key of theirs is hot.
BUCKETS, SHARE = 32, 0.002


def catalog_of(rows, **columns):
    """Catalogue rows from expressions; columns that are not given are null."""
    fields = [f.split() for f in CATALOG.split(", ")]
    return rows.select(
        *[columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields]
    )


def text_of(name):
    return F.col(name).cast("string")


def joined_text(*parts):
    return F.concat(*[p if isinstance(p, F.Column) else F.lit(p) for p in parts])


@query(
    "site_keys",
    """
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'MabnaDP2' WHEN 2 THEN 'TadbirPardaz'
        ELSE 'RayanHamafza' END AS site_type,
      CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR)
        WHEN c_custkey % 4 = 2 THEN '' ELSE '1' END AS portfolio_id
    FROM customer
    """,
)
def site_keys(t):
    """Site key of every row: null and blank portfolios become the vendor's default."""
    key = F.col("c_custkey")
    catalog = catalog_of(
        t.customer,
        l18=key,
        url=F.col("c_name"),
        portfolio_id=F.when(key % 3 == 0, text_of("c_custkey")).when(key % 3 == 1, ""),
        site_type=F.when(key % 4 == 1, C.MABNA).when(key % 4 == 2, C.TADBIR).when(key % 4 == 3, C.RAYAN),
    )
    return with_site(catalog).select(
        F.col("l18").cast("bigint").alias("c_custkey"), "site.site_type", "site.portfolio_id"
    )


def event_captures(t):
    """Every event as a capture of its user's page, at the event's time."""
    return t.events.select(
        F.when(F.col("user_id") % 2 == 0, C.MABNA).otherwise(C.TADBIR).alias("site_type"),
        joined_text("http://u", text_of("user_id"), ".ir/").alias("url"),
        F.when(F.col("event_type") != "error", F.lit("7")).alias("portfolio_id"),
        F.lit("home").alias("endpoint"),
        F.length("event_type").alias("page"),
        F.lit(200).alias("status"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.col("props").alias("body"),
    )


@query(
    "newest_capture",
    """
    WITH e AS (
      SELECT *, max(ts) OVER (PARTITION BY user_id, event_type = 'error', length(event_type)) AS newest
      FROM events
    )
    SELECT 'http://u' || user_id || '.ir/' AS url, CASE WHEN event_type <> 'error' THEN '7' END AS portfolio_id,
      CAST(length(event_type) AS BIGINT) AS page, props AS body
    FROM e WHERE ts = newest
    """,
)
def newest_capture(t):
    page = F.col("page").cast("bigint").alias("page")
    return latest_capture(event_captures(t)).select("url", "portfolio_id", page, "body")


@query(
    "portfolio_selection",
    """
    SELECT CASE WHEN user_id % 2 = 0 THEN 'MabnaDP2' ELSE 'TadbirPardaz' END AS site_type, count(*) AS n
    FROM events WHERE event_type = 'error' AND user_id % 2 = 0 GROUP BY ALL
    """,
)
def portfolio_selection(t):
    """Captures of portfolio 1, which a missing id means for one of the two vendors."""
    chosen = for_portfolio(event_captures(t), "1")
    return chosen.groupBy("site_type").agg(F.count(F.lit(1)).alias("n"))


# Registry feed -------------------------------------------------------------------------


def part_registry(t):
    return t.part.select(
        text_of("p_partkey").alias("regNo"),
        F.when(F.col("p_size") % 3 != 0, text_of("p_partkey")).alias("insCode"),
        F.lit(1).alias("groupId"),
        F.when(F.col("p_type") == "ECONOMY", F.lit(None))
        .when(F.col("p_type") == "SMALL", F.lit("Private"))
        .otherwise(F.lit("Negotiable"))
        .alias("typeOfInvest"),
        F.col("p_size").alias("fundType"),
        (F.col("p_retailprice") > 910).alias("isCompleted"),
        joined_text("S", text_of("p_partkey")).alias("smallSymbolName"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("websiteAddress"),
        (F.col("p_size") % 7 - 2).alias("dividendIntervalPeriod"),
    )


@query(
    "registry_filter_label",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS reg_no, 'S' || p_partkey AS l18, p_name AS name,
      CASE p_size WHEN 4 THEN 'Fixed' WHEN 5 THEN 'Commodity' WHEN 6 THEN 'Stock' WHEN 7 THEN 'Mixed'
        WHEN 17 THEN 'FOF' WHEN 18 THEN 'REIT' WHEN 21 THEN 'Sector' WHEN 22 THEN 'Leveraged'
        WHEN 23 THEN 'Index' WHEN 24 THEN 'Guarantee' ELSE CAST(p_size AS VARCHAR) END AS type,
      p_brand AS domain, CASE WHEN p_size % 3 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS ins_code,
      CAST(1 AS BIGINT) AS group_id
    FROM part
    WHERE p_type NOT IN ('ECONOMY', 'SMALL') AND p_size NOT IN (11, 12, 13, 14, 16)
      AND p_retailprice > 910
    """,
)
def registry_filter_label(t):
    funds = reconcile.registry_funds(part_registry(t))
    return funds.withColumn("group_id", F.col("group_id").cast("bigint"))


@query(
    "paying_funds",
    """
    SELECT 'S' || p_partkey AS l18, CAST(p_size % 7 - 2 AS BIGINT) AS dps_interval FROM part
    WHERE p_type NOT IN ('ECONOMY', 'SMALL') AND p_size % 7 - 2 > 0
    """,
)
def paying_funds(t):
    found = reconcile.dividend_intervals(part_registry(t))
    return found.select("l18", F.col("dps_interval").cast("bigint").alias("dps_interval"))


# Joins with feeds ----------------------------------------------------------------------


def nation_domain(name):
    return joined_text("n", text_of(name), ".example.ir")


@query(
    "probe_join",
    """
    WITH p AS (
      SELECT 'n' || s_nationkey || '.example.ir' AS domain,
        'http://n' || s_nationkey || '.example.ir/' AS url,
        CASE WHEN s_suppkey % 2 = 0 THEN 'MabnaDP2' ELSE 'TadbirPardaz' END AS site_type
      FROM supplier
    ), found AS (
      SELECT domain, min(url) AS url, min(site_type) AS site_type FROM p
      WHERE domain NOT IN (SELECT 'n' || n_nationkey || '.example.ir' FROM nation WHERE n_regionkey = 0)
      GROUP BY domain
    )
    SELECT c_custkey, f.url, f.site_type
    FROM customer LEFT JOIN found f ON c_acctbal > 0
      AND f.domain = 'n' || c_nationkey || '.example.ir'
    """,
)
def probe_join(t):
    """Customers as registry funds on their nation's domain; one region is known already."""
    funds = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 0, nation_domain("c_nationkey")).alias("domain"),
    )
    domain = nation_domain("s_nationkey")
    probes = t.supplier.select(
        domain.alias("domain"),
        joined_text("http://", domain, "/").alias("url"),
        F.when(F.col("s_suppkey") % 2 == 0, C.MABNA).otherwise(C.TADBIR).alias("site_type"),
    )
    known = t.nation.select(
        F.when(
            F.col("n_regionkey") == 0, joined_text("http://", nation_domain("n_nationkey"), "/x")
        ).alias("url")
    )
    return reconcile.add_site(funds, probes, known).select("c_custkey", "url", "site_type")


@query(
    "domains_to_probe",
    """
    SELECT DISTINCT 'n' || c_nationkey || '.example.ir' AS domain FROM customer
    WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)
    """,
)
def domains_to_probe(t):
    funds = t.customer.select(nation_domain("c_nationkey").alias("domain"))
    known = t.nation.select(
        F.when(
            F.col("n_regionkey") == 0, joined_text("https://", nation_domain("n_nationkey"), "/")
        ).alias("url")
    )
    return reconcile.domains_to_probe(funds, known)


@query(
    "reconcile_left",
    """
    WITH f AS (
      SELECT s_nationkey AS reg, s_suppkey % 3 AS grp, min(s_name) AS domain
      FROM supplier WHERE s_suppkey % 5 <> 0 GROUP BY ALL
    )
    SELECT c_custkey, 'new ' || f.reg AS type,
      CASE WHEN c_custkey % 4 = 0 THEN 'http://own/' ELSE 'http://' || f.domain || '/' END AS url,
      CASE WHEN c_custkey % 6 = 0 THEN 'MabnaDP2' WHEN f.reg IS NOT NULL THEN 'TadbirPardaz' END AS site_type
    FROM customer LEFT JOIN f ON c_nationkey = f.reg AND c_custkey % 3 = f.grp
    WHERE f.reg IS NOT NULL
    UNION ALL
    SELECT c_custkey, 'old', CASE WHEN c_custkey % 4 = 0 THEN 'http://own/' END,
      CASE WHEN c_custkey % 6 = 0 THEN 'MabnaDP2' END
    FROM customer LEFT JOIN f ON c_nationkey = f.reg AND c_custkey % 3 = f.grp
    WHERE f.reg IS NULL
    """,
)
def reconcile_left(t):
    """Customers as catalogue, suppliers as a registry that repeats its keys."""
    key = F.col("c_custkey")
    catalog = catalog_of(
        t.customer,
        l18=key,
        type=F.lit("old"),
        reg_no=F.col("c_nationkey"),
        url=F.when(key % 4 == 0, F.lit("http://own/")),
        site_type=F.when(key % 6 == 0, F.lit(C.MABNA)),
        group_id=key % 3,
    )
    supplied = F.col("s_suppkey") % 5 != 0
    funds = t.supplier.select(
        F.when(supplied, text_of("s_nationkey")).alias("reg_no"),
        (F.col("s_suppkey") % 3).cast("int").alias("group_id"),
        F.col("s_name").alias("domain"),
        joined_text("new ", text_of("s_nationkey")).alias("type"),
        F.lit(None).cast("string").alias("url"),
        F.lit(C.TADBIR).alias("site_type"),
    )
    updated = reconcile.update_from_registry(catalog, funds)
    return updated.select(F.col("l18").cast("bigint").alias("c_custkey"), "type", "url", "site_type")


@query(
    "coalesce_update",
    """
    SELECT CASE WHEN p_size > 40 THEN 'L' || p_partkey ELSE 'old' || p_partkey END AS l18,
      CASE WHEN p_size BETWEEN 10 AND 40 THEN 'N' || p_name ELSE p_name END AS name,
      CAST(p_partkey AS VARCHAR) AS ins_code, p_type AS type
    FROM part
    """,
)
def coalesce_update(t):
    """The instrument feed has a new symbol for some, a new name for others, and own columns."""
    catalog, feed = instruments_of_parts(t)
    updated = reconcile.update_from_instruments(catalog, reconcile.instrument_feed(feed))
    return updated.select("l18", "name", "ins_code", "type")


@query("coalesce_update_stored", ORACLES["coalesce_update"])
def coalesce_update_stored(t):
    """The same from a feed that is stored in buckets of the instrument code."""
    catalog, feed = instruments_of_parts(t)
    stored = reconcile.store_updates(reconcile.instrument_feed(feed), ["ins_code"], BUCKETS)
    updated = reconcile.update_from_stored(catalog, [stored], ["ins_code"], share=SHARE)
    return updated.select("l18", "name", "ins_code", "type")


def instruments_of_parts(t):
    key, size = text_of("p_partkey"), F.col("p_size")
    catalog = catalog_of(
        t.part,
        l18=joined_text("old", key),
        name=F.col("p_name"),
        type=F.col("p_type"),
        ins_code=key,
    )
    feed = t.part.select(
        key.alias("ins_code"),
        F.when(size > 40, joined_text("L", key)).alias("l18"),
        F.when(size.between(10, 40), joined_text("N", F.col("p_name"))).alias("name"),
        F.lit("x").alias("isin"),
        F.lit("y").alias("l30"),
        F.lit("z").alias("cisin"),
        size.alias("other"),
    )
    return catalog, feed


@query(
    "anti_null_safe",
    """
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS k FROM customer),
      o AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders)
    SELECT c_custkey, 'negated' AS test FROM c WHERE k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM o WHERE o.k = c.k)
    UNION ALL
    SELECT c_custkey, 'new fund' FROM c WHERE k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM o WHERE o.k = c.k)
    """,
)
def anti_null_safe(t):
    key = F.when(F.col("c_custkey") % 10 != 0, text_of("c_custkey"))
    paid = F.when(F.col("o_orderstatus") != "P", text_of("o_custkey"))
    funds = t.customer.select("c_custkey", key.alias("reg_no"))
    stored = t.orders.select(paid.alias("reg_no"))
    lost = reconcile.missing_from_registry(funds, stored.withColumnRenamed("reg_no", "regNo"))
    new = reconcile.new_funds(funds, stored)
    return lost.select("c_custkey", F.lit("negated").alias("test")).unionByName(
        new.select("c_custkey", F.lit("new fund").alias("test"))
    )


@query(
    "name_unique_hit",
    """
    WITH hits AS (
      SELECT p_name, min(p_partkey) AS code FROM part GROUP BY p_name HAVING count(*) = 1
      UNION ALL SELECT 'only ' || p_partkey, p_partkey FROM part
    ), f AS (
      SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE 'only ' || p_partkey END AS name,
        CASE WHEN p_size % 2 = 0 THEN 'own' END AS code FROM part
    )
    SELECT f.p_partkey, coalesce(CASE WHEN f.name IN (SELECT name FROM f WHERE code IS NULL)
      THEN CAST(h.code AS VARCHAR) END, f.code) AS ins_code
    FROM f LEFT JOIN hits h ON h.p_name = f.name
    """,
)
def name_unique_hit(t):
    """Names with one hit in the feed give the code; part names repeat, so most have several."""
    size, key = F.col("p_size"), text_of("p_partkey")
    only = joined_text("only ", key)
    funds = t.part.select(
        "p_partkey",
        F.when(size > 25, F.col("p_name")).otherwise(only).alias("name"),
        F.when(size % 2 == 0, F.lit("own")).alias("ins_code"),
    )
    feed = t.part.select(F.col("p_name").alias("name"), key.alias("ins_code")).unionByName(
        t.part.select(only.alias("name"), key.alias("ins_code"))
    )
    return reconcile.add_ins_code(funds, feed).select("p_partkey", "ins_code")


@query(
    "fill_nulls",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS l18,
      CASE WHEN o_orderstatus = 'F' THEN 'old' WHEN o_custkey % 3 = 0 THEN 'r' || o_orderkey END AS reg_no,
      CASE WHEN o_custkey % 4 = 0 THEN CAST(o_custkey % 12 AS BIGINT) ELSE 7 END AS dps_interval,
      CASE WHEN o_custkey % 5 = 0 THEN 'MabnaDP2' ELSE 'TadbirPardaz' END AS site_type
    FROM orders
    """,
)
def fill_nulls(t):
    catalog, numbers, intervals, types = updates_of_orders(t)
    filled = reconcile.fill_reg_no(catalog, numbers)
    filled = reconcile.set_dps_interval(filled, intervals)
    filled = reconcile.correct_site_type(filled, types)
    return filled.select(
        "l18", "reg_no", F.col("dps_interval").cast("bigint").alias("dps_interval"), "site_type"
    )


@query("fill_nulls_stored", ORACLES["fill_nulls"])
def fill_nulls_stored(t):
    """All three columns from stored tables: the catalogue rows are shuffled once."""
    catalog, *updates = updates_of_orders(t)
    stored = [reconcile.store_updates(u, ["l18"], BUCKETS) for u in updates]
    filled = reconcile.update_from_stored(catalog, stored, ["l18"], filled=("reg_no",), share=SHARE)
    return filled.select(
        "l18", "reg_no", F.col("dps_interval").cast("bigint").alias("dps_interval"), "site_type"
    )


def updates_of_orders(t):
    key, cust = text_of("o_orderkey"), F.col("o_custkey")
    catalog = catalog_of(
        t.orders,
        l18=key,
        reg_no=F.when(F.col("o_orderstatus") == "F", F.lit("old")),
        dps_interval=F.lit(7),
        site_type=F.lit(C.TADBIR),
    )
    numbers = t.orders.select(
        key.alias("l18"), F.when(cust % 3 == 0, joined_text("r", key)).alias("reg_no")
    )
    intervals = t.orders.select(
        key.alias("l18"), F.when(cust % 4 == 0, (cust % 12).cast("int")).alias("dps_interval")
    )
    types = t.orders.select(key.alias("l18"), F.when(cust % 5 == 0, C.MABNA).alias("site_type"))
    return catalog, numbers, intervals, types


@query(
    "missing_reg_no",
    "SELECT CAST(o_orderkey AS VARCHAR) AS l18, 'http://c' || o_custkey || '/' AS url FROM orders "
    "WHERE o_orderstatus <> 'F'",
)
def missing_reg_no(t):
    catalog = catalog_of(
        t.orders,
        l18=text_of("o_orderkey"),
        reg_no=F.when(F.col("o_orderstatus") == "F", F.lit("known")),
        url=joined_text("http://c", text_of("o_custkey"), "/"),
    )
    return reconcile.without_reg_no(catalog).select("l18", "url")


@query(
    "append_diagonal",
    """
    SELECT 'c' || c_custkey AS l18, c_name AS name, NULL AS type, c_nationkey % 100 AS group_id FROM customer
    UNION ALL
    SELECT 's' || s_suppkey, s_name, 'Stock', s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0
    """,
)
def append_diagonal(t):
    catalog = catalog_of(
        t.customer,
        l18=joined_text("c", text_of("c_custkey")),
        name=F.col("c_name"),
        group_id=F.col("c_nationkey") % 100,
    ).drop("type")
    new = t.supplier.select(
        joined_text("s", text_of("s_suppkey")).alias("l18"),
        F.col("s_name").alias("name"),
        F.lit("Stock").alias("type"),
        F.lit("dropped").alias("domain"),
        F.when(F.col("s_suppkey") % 4 != 0, text_of("s_suppkey")).alias("ins_code"),
        F.col("s_suppkey").alias("group_id"),
    )
    grown = reconcile.append_new(catalog, new)
    return grown.select("l18", "name", "type", F.col("group_id").cast("bigint").alias("group_id"))


@query(
    "new_without_code",
    "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 5000",
)
def new_without_code(t):
    code = F.when(F.col("s_acctbal") >= 5000, text_of("s_suppkey"))
    return reconcile.without_code(t.supplier.withColumn("ins_code", code)).select("s_suppkey", "s_name")


@query(
    "symbol_lookup",
    """
    SELECT o_orderkey, CASE WHEN c.c_custkey IS NOT NULL THEN 'http://c' || c.c_custkey || '/' END AS url,
      c.c_custkey IS NULL AS missing
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 2000) c ON c.c_custkey = o_custkey
    """,
)
def symbol_lookup(t):
    """Orders ask for their customer's site; customers with a small balance are not in the catalogue."""
    catalog, wanted = sites_of_customers(t)
    return reconcile.sites_of(wanted, catalog).select("o_orderkey", "url", "missing")


@query("symbol_lookup_stored", ORACLES["symbol_lookup"])
def symbol_lookup_stored(t):
    """The same from a catalogue that is stored in buckets of the symbol."""
    catalog, wanted = sites_of_customers(t)
    sites = reconcile.store_sites(catalog, BUCKETS)
    return reconcile.sites_of(wanted, sites, share=SHARE).select("o_orderkey", "url", "missing")


def sites_of_customers(t):
    key = text_of("c_custkey")
    catalog = catalog_of(
        t.customer,
        l18=F.when(F.col("c_acctbal") > 2000, joined_text("c", key)),
        url=joined_text("http://c", key, "/"),
        site_type=F.lit(C.TADBIR),
    )
    wanted = t.orders.select("o_orderkey", joined_text("c", text_of("o_custkey")).alias("l18"))
    return catalog, wanted


# Coverage ------------------------------------------------------------------------------


def feeds_and_catalog(t):
    def feed(rows, key):
        return rows.select(joined_text("S", text_of(key)).alias(compare.EXCHANGE_SYMBOL))

    feeds = [feed(t.part, "p_partkey"), feed(t.lineitem, "l_partkey"), feed(t.orders, "o_custkey")]
    symbol = joined_text("S", text_of("p_partkey"))
    catalog = catalog_of(t.part, l18=F.when(F.col("p_size") <= 30, symbol))
    ignored = C.IGNORED_DESCRIPTIONS
    descriptions = t.part.select(
        joined_text("S", text_of("p_partkey")).alias("l18"),
        F.when(F.col("p_size") % 4 == 0, ignored[0])
        .when(F.col("p_size") % 4 == 1, ignored[1])
        .when(F.col("p_size") % 4 == 2, F.lit("plain"))
        .alias("description"),
    )
    return feeds, catalog, descriptions


_GAP = """
    SELECT s.k FROM (SELECT p_partkey AS k FROM part UNION SELECT l_partkey FROM lineitem
      UNION SELECT o_custkey FROM orders) s LEFT JOIN part ON p_partkey = s.k
    WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = s.k AND p.p_size <= 30)
"""


@query("coverage_gap", f"SELECT 'S' || k AS l18 FROM ({_GAP})")
def coverage_gap(t):
    feeds, catalog, _ = feeds_and_catalog(t)
    return compare.missing_symbols(feeds, catalog)


@query(
    "coverage_valid_count",
    f"SELECT count(*) AS n_missing FROM ({_GAP} AND (p_size IS NULL OR p_size % 4 NOT IN (0, 1)))",
)
def coverage_valid_count(t):
    return count_missing(compare_with_exchange(*feeds_and_catalog(t)))


# Quality -------------------------------------------------------------------------------


def event_keys(t):
    return t.events.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("url"),
        F.when(F.col("value") > 5, F.get_json_object("props", "$.k")).alias("portfolio_id"),
    )


_EVENT_KEYS = """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS url,
      CASE WHEN value > 5 THEN json_extract_string(props, '$.k') END AS portfolio_id
    FROM events
"""


@query(
    "dup_composite",
    f"""
    SELECT event_id FROM (SELECT event_id, count(*) OVER (PARTITION BY url, portfolio_id) AS n
      FROM ({_EVENT_KEYS})) WHERE n > 1
    """,
)
def dup_composite(t):
    return quality.duplicate_rows(event_keys(t), ["url", "portfolio_id"]).select("event_id")


@query(
    "dup_single",
    f"""
    SELECT 'url' AS column_name, CAST(url AS VARCHAR) AS value, count(*) AS n FROM ({_EVENT_KEYS})
    GROUP BY url HAVING count(*) > 1
    UNION ALL
    SELECT 'portfolio_id', portfolio_id, count(*) FROM ({_EVENT_KEYS})
    GROUP BY portfolio_id HAVING count(*) > 1
    """,
)
def dup_single(t):
    return quality.duplicate_values(event_keys(t), ["url", "portfolio_id"])


@query(
    "distinct_urls_per_key",
    f"""
    SELECT url, count(DISTINCT portfolio_id) + max(CASE WHEN portfolio_id IS NULL THEN 1 ELSE 0 END) AS cnt
    FROM ({_EVENT_KEYS}) GROUP BY url
    """,
)
def distinct_urls_per_key(t):
    return quality.values_per_key(event_keys(t), "url", "portfolio_id")


@query(
    "ids_per_url",
    f"SELECT url, portfolio_id, count(*) AS n FROM ({_EVENT_KEYS}) GROUP BY url, portfolio_id",
)
def ids_per_url(t):
    return quality.ids_per_url(event_keys(t))


@query(
    "one_row_per_url",
    """
    SELECT 'http://n' || c_nationkey || '/' AS url, min(c_name) AS l18 FROM customer GROUP BY c_nationkey
    """,
)
def one_row_per_url(t):
    catalog = catalog_of(
        t.customer, l18=F.col("c_name"), url=joined_text("http://n", text_of("c_nationkey"), "/")
    )
    return quality.one_per_url(catalog).select("url", "l18")


@query(
    "id_set_equality",
    """
    WITH stored AS (
      SELECT DISTINCT l_partkey AS u, CASE WHEN l_partkey % 9 <> 0 THEN l_suppkey END AS id FROM lineitem
    ), flat AS (
      SELECT u, CASE WHEN u % 9 = 0 THEN 1 ELSE id END AS id FROM stored
    ), site AS (
      SELECT DISTINCT l_partkey AS u, CASE WHEN l_partkey % 9 = 0 THEN 1 ELSE l_suppkey END AS id
      FROM lineitem WHERE l_partkey % 9 = 0 OR l_suppkey % 10 <> 3
      UNION SELECT l_partkey, 1000000 FROM lineitem WHERE l_partkey % 7 = 0
    ), checked AS (SELECT DISTINCT u FROM site)
    SELECT u, id, FALSE AS on_site FROM (SELECT * FROM flat EXCEPT SELECT * FROM site)
      WHERE u IN (SELECT u FROM checked)
    UNION ALL SELECT u, id, TRUE FROM (SELECT * FROM site EXCEPT SELECT * FROM flat)
    """,
)
def id_set_equality(t):
    """Suppliers per part as portfolio ids; the site lacks some and has one more for others."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    url = text_of("l_partkey").alias("url")
    catalog = t.lineitem.select(
        url, F.when(part % 9 != 0, text_of("l_suppkey")).alias("portfolio_id")
    )
    same = F.when(part % 9 == 0, F.lit("1")).when(supp % 10 != 3, text_of("l_suppkey"))
    extra = F.when(part % 7 == 0, F.lit("1000000"))
    found = t.lineitem.select(url, F.explode(F.array_compact(F.array(same, extra))).alias("portfolio_id"))
    differing = quality.portfolio_mismatches(found, catalog)
    return differing.select(
        F.col("url").cast("bigint").alias("u"),
        F.col("portfolio_id").cast("bigint").alias("id"),
        "on_site",
    )


def flawed_catalog(t):
    """Suppliers as a catalogue with flaws in most columns."""
    key, name = F.col("s_suppkey"), F.col("s_name")
    labels = F.array(*[F.lit(v) for v in C.FUND_TYPE_LABELS.values()])
    return catalog_of(
        t.supplier,
        l18=F.when(key % 20 == 3, F.lit("same")).otherwise(name),
        name=F.when(key % 25 != 1, name),
        type=F.when(key % 13 == 0, F.lit("odd")).otherwise(F.get(labels, (key % 10).cast("int"))),
        ins_code=F.when(key % 3 != 0, text_of("s_suppkey")).otherwise(F.lit("i")),
        reg_no=F.when(key % 17 != 0, text_of("s_nationkey")),
        url=F.when(
            key % 4 != 0,
            joined_text("http://n", text_of("s_nationkey"), F.when(key % 11 == 0, "#").otherwise(""), "/"),
        ),
        portfolio_id=F.when(key % 2 == 0, text_of("s_suppkey")),
        site_type=F.when(key % 19 != 0, F.lit(C.TADBIR)),
    )


_FLAWED = """
    SELECT CASE WHEN s_suppkey % 20 = 3 THEN 'same' ELSE s_name END AS l18,
      CASE WHEN s_suppkey % 25 <> 1 THEN s_name END AS name,
      CASE WHEN s_suppkey % 13 = 0 THEN 'odd' ELSE 'Fixed' END AS type,
      CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey AS VARCHAR) ELSE 'i' END AS ins_code,
      CASE WHEN s_suppkey % 17 <> 0 THEN CAST(s_nationkey AS VARCHAR) END AS reg_no,
      CASE WHEN s_suppkey % 4 <> 0 THEN 'http://n' || s_nationkey
        || CASE WHEN s_suppkey % 11 = 0 THEN '#' ELSE '' END || '/' END AS url,
      CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS portfolio_id,
      CASE WHEN s_suppkey % 19 <> 0 THEN 'TadbirPardaz' END AS site_type
    FROM supplier
"""

_STATIC_RULES = """
    SELECT 'url has a fragment' AS rule, l18 AS key, url AS detail FROM c WHERE url LIKE '%#%'
    UNION ALL SELECT 'unknown type', l18, type FROM c WHERE type = 'odd'
    UNION ALL SELECT 'no site_type', l18, url FROM c WHERE site_type IS NULL
    UNION ALL SELECT 'no reg_no', l18, url FROM c WHERE reg_no IS NULL
    UNION ALL SELECT 'repeated l18', l18, CAST(count(*) AS VARCHAR) FROM c GROUP BY l18 HAVING count(*) > 1
    UNION ALL SELECT 'repeated name', name, CAST(count(*) AS VARCHAR) FROM c GROUP BY name HAVING count(*) > 1
    UNION ALL SELECT 'repeated ins_code', ins_code, CAST(count(*) AS VARCHAR) FROM c GROUP BY ins_code HAVING count(*) > 1
    UNION ALL SELECT 'repeated url and portfolio_id', concat_ws(' ', url, portfolio_id), CAST(count(*) AS VARCHAR)
      FROM c GROUP BY url, portfolio_id HAVING count(*) > 1
    UNION ALL SELECT 'several urls for reg_no', reg_no,
      CAST(count(DISTINCT url) + max(CASE WHEN url IS NULL THEN 1 ELSE 0 END) AS VARCHAR)
      FROM c GROUP BY reg_no HAVING count(DISTINCT url) + max(CASE WHEN url IS NULL THEN 1 ELSE 0 END) > 1
"""


@query("rule_violations", f"WITH c AS ({_FLAWED}) {_STATIC_RULES}")
def rule_violations(t):
    return check_static(flawed_catalog(t))


def supplier_homes(t):
    """Landed home pages of suppliers: two vendors, each page with its registration number."""
    key = F.col("s_suppkey")
    number = text_of("s_suppkey")
    tadbir = joined_text(
        C.TADBIR_MARKER,
        "<td>شماره ثبت نزد سازمان بورس و اوراق بهادار</td>",
        '<td style="text-align:left">',
        number,
        "</td>",
    )
    none = F.lit("<html>nothing</html>")
    body = F.when(key % 5 == 0, F.lit(C.TADBIR_MARKER)).when(key % 7 == 0, none).otherwise(tadbir)
    return landed(
        t.supplier, C.TADBIR, joined_text("http://s", number, ".ir/"), "home", body, portfolio_id=""
    )


def checked_catalog(t):
    """Suppliers as a catalogue without static flaws, at odds with some of their sites."""
    key, name = F.col("s_suppkey"), F.col("s_name")
    return catalog_of(
        t.supplier,
        l18=name,
        name=name,
        type=F.lit("Stock"),
        ins_code=text_of("s_suppkey"),
        reg_no=F.when(key % 6 == 0, joined_text("x", text_of("s_suppkey"))).otherwise(
            text_of("s_suppkey")
        ),
        url=joined_text("http://s", text_of("s_suppkey"), ".ir/"),
        portfolio_id=F.when(key % 8 == 0, F.lit("4")),
        site_type=F.when(key % 9 == 0, F.lit(C.MABNA)).otherwise(F.lit(C.TADBIR)),
    )


@query(
    "live_check",
    """
    WITH c AS (
      SELECT s_suppkey AS k, s_name AS l18, 'http://s' || s_suppkey || '.ir/' AS url,
        CASE WHEN s_suppkey % 6 = 0 THEN 'x' || s_suppkey ELSE CAST(s_suppkey AS VARCHAR) END AS reg_no,
        CASE WHEN s_suppkey % 8 = 0 THEN '4' ELSE '1' END AS id,
        CASE WHEN s_suppkey % 9 = 0 THEN 'MabnaDP2' ELSE 'TadbirPardaz' END AS site_type,
        CASE WHEN s_suppkey % 5 = 0 THEN 'none' WHEN s_suppkey % 7 = 0 THEN 'blank' ELSE 'full' END AS page
      FROM supplier
    )
    SELECT 'other vendor detected' AS rule, l18 AS key, 'MabnaDP2 -> TadbirPardaz' AS detail
      FROM c WHERE site_type = 'MabnaDP2' AND page <> 'blank'
    UNION ALL SELECT 'unknown vendor', url, NULL FROM c WHERE page = 'blank'
    UNION ALL SELECT 'reg_no missing on site', l18, reg_no FROM c
      WHERE site_type = 'TadbirPardaz' AND page <> 'full'
    UNION ALL SELECT 'reg_no differs', l18, reg_no || ' / ' || k FROM c
      WHERE site_type = 'TadbirPardaz' AND page = 'full' AND reg_no <> CAST(k AS VARCHAR)
    UNION ALL SELECT 'portfolio not on site', url, '4' FROM c WHERE id = '4'
    UNION ALL SELECT 'portfolio not in catalogue', url, '1' FROM c WHERE id = '4'
    """,
)
def live_check(t):
    return check_live(checked_catalog(t), supplier_homes(t)).violations


@query(
    "live_correction",
    """
    SELECT s_name AS l18, CASE WHEN s_suppkey % 9 = 0 AND s_suppkey % 5 <> 0 AND s_suppkey % 7 = 0
      THEN 'MabnaDP2' ELSE 'TadbirPardaz' END AS site_type FROM supplier
    """,
)
def live_correction(t):
    return check_live(checked_catalog(t), supplier_homes(t)).corrected.select("l18", "site_type")


@query(
    "reg_no_from_sites",
    """
    SELECT s_name AS l18, CASE WHEN s_suppkey % 6 = 0 THEN 'x' || s_suppkey
      WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS reg_no
    FROM supplier
    """,
)
def reg_no_from_sites(t):
    key, number = F.col("s_suppkey"), text_of("s_suppkey")
    catalog = catalog_of(
        t.supplier,
        l18=F.col("s_name"),
        reg_no=F.when(key % 6 == 0, joined_text("x", number)),
        url=joined_text("http://s", number, ".ir/"),
        site_type=F.lit(C.TADBIR),
    )
    return fill_reg_numbers(catalog, supplier_homes(t)).select("l18", "reg_no")


@query(
    "intervals_from_registry",
    """
    SELECT 'S' || p_partkey AS l18, CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL') AND p_size % 7 - 2 > 0
      THEN CAST(p_size % 7 - 2 AS BIGINT) ELSE 9 END AS dps_interval
    FROM part
    """,
)
def intervals_from_registry(t):
    symbol = joined_text("S", text_of("p_partkey"))
    catalog = catalog_of(t.part, l18=symbol, dps_interval=F.lit(9))
    filled = set_payout_intervals(catalog, part_registry(t))
    return filled.select("l18", F.col("dps_interval").cast("bigint").alias("dps_interval"))


# Storage and the whole update ----------------------------------------------------------


@query(
    "catalog_roundtrip",
    """
    SELECT translate(s_name, 'ie', 'یe') || CASE WHEN s_suppkey % 3 = 0 THEN ', "x"' ELSE '' END AS l18,
      'a' || chr(10) || s_suppkey AS name, CASE WHEN s_suppkey % 2 = 0 THEN '' END AS url,
      '  ' || s_suppkey || ' ' AS reg_no, CAST(s_nationkey AS BIGINT) AS group_id
    FROM supplier
    """,
)
def catalog_roundtrip(t):
    """Suppliers written as catalogue CSV and read back: quotes, commas, line breaks, blanks."""
    key = F.col("s_suppkey")
    catalog = catalog_of(
        t.supplier,
        l18=joined_text(
            F.translate("s_name", "i", "ي"), F.when(key % 3 == 0, ', "x"').otherwise("")
        ),
        name=joined_text("a\n", text_of("s_suppkey")),
        url=F.when(key % 2 == 0, F.lit("")),
        reg_no=joined_text("  ", text_of("s_suppkey"), " "),
        group_id=F.col("s_nationkey"),
    )
    path = shared_folder(t.spark, "catalog")
    sink_catalog_csv(catalog, path)
    stored = scan_catalog_csv(t.spark, path)
    return stored.select(
        "l18", "name", "url", "reg_no", F.col("group_id").cast("bigint").alias("group_id")
    )


def update_inputs(t, registered=None):
    """Every customer as a catalogue row and as a registry row, instruments and probes derived from them.

    Customers of a small balance are catalogued without their number, so that the registry has
    them as new funds; those not ``registered`` have another number there.
    """
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    number = text_of("c_custkey")
    sited = (key % 3 == 0) & (nation % 4 != 0)
    numbered = (F.col("c_acctbal") > 3000) & (key % 50 != 0)
    catalog = catalog_of(
        t.customer,
        l18=joined_text("S", number),
        name=F.col("c_name"),
        type=F.lit("Old"),
        ins_code=joined_text("i", number),
        reg_no=F.when(numbered, number),
        url=F.when(sited, joined_text("http://n", text_of("c_nationkey"), ".ir/")),
        site_type=F.when(sited, F.lit(C.RAYAN)),
        group_id=nation % 5,
    )
    registry = t.customer.select(
        (number if registered is None else F.when(registered, number).otherwise(joined_text("R", number))).alias("regNo"),
        F.when(key % 2 == 0, joined_text("i", number)).alias("insCode"),
        (nation % 5).alias("groupId"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Private").otherwise("Negotiable").alias("typeOfInvest"),
        (key % 10 + 4).cast("int").alias("fundType"),
        (key % 13 != 0).alias("isCompleted"),
        joined_text("S", number).alias("smallSymbolName"),
        F.col("c_name").alias("name"),
        F.when(key % 4 != 0, joined_text("n", text_of("c_nationkey"), ".ir")).alias("websiteAddress"),
        F.lit(1).alias("dividendIntervalPeriod"),
    )
    instruments = t.customer.select(
        F.when(key % 5 != 0, joined_text("i", number)).alias("ins_code"),
        F.when(key % 6 == 0, joined_text("T", number)).alias("l18"),
        F.col("c_name").alias("name"),
        F.lit("x").alias("isin"),
        F.lit("y").alias("cisin"),
        F.lit("z").alias("l30"),
    )
    probed = F.col("n_regionkey") != 1
    probes = t.nation.select(
        F.when(probed, joined_text("n", text_of("n_nationkey"), ".ir")).alias("domain"),
        joined_text("http://n", text_of("n_nationkey"), ".ir/").alias("url"),
        F.lit(C.TADBIR).alias("site_type"),
    )
    return catalog, registry, instruments, probes


_UPDATE = """
    WITH registry AS (
      SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS reg_no, c_nationkey % 5 AS grp,
        CASE WHEN c_custkey % 2 = 0 THEN 'i' || c_custkey END AS ins_code, 'S' || c_custkey AS l18, c_name AS name,
        CASE c_custkey % 10 + 4 WHEN 4 THEN 'Fixed' WHEN 5 THEN 'Commodity' WHEN 6 THEN 'Stock'
          WHEN 7 THEN 'Mixed' ELSE CAST(c_custkey % 10 + 4 AS VARCHAR) END AS type,
        CASE WHEN c_custkey % 4 <> 0 THEN 'n' || c_nationkey || '.ir' END AS domain
      FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_custkey % 10 + 4 NOT IN (11, 12, 13, 14, 16)
        AND c_custkey % 13 <> 0
    ), stored AS (
      SELECT c_custkey AS k, 'S' || c_custkey AS l18, c_name AS name, 'Old' AS type, 'i' || c_custkey AS ins_code,
        CASE WHEN c_acctbal > 3000 AND c_custkey % 50 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS reg_no,
        CASE WHEN c_custkey % 3 = 0 AND c_nationkey % 4 <> 0 THEN 'http://n' || c_nationkey || '.ir/' END AS url,
        CASE WHEN c_custkey % 3 = 0 AND c_nationkey % 4 <> 0 THEN 'RayanHamafza' END AS site_type, c_nationkey % 5 AS grp
      FROM customer
    ), known AS (SELECT DISTINCT regexp_extract(url, '//([^/]+)/', 1) AS domain FROM stored WHERE url IS NOT NULL),
    found AS (
      SELECT 'n' || n_nationkey || '.ir' AS domain, 'http://n' || n_nationkey || '.ir/' AS url FROM nation
      WHERE n_regionkey <> 1 AND 'n' || n_nationkey || '.ir' NOT IN (SELECT domain FROM known)
    ), existing AS (
      SELECT s.l18, s.name, coalesce(r.type, s.type) AS type, s.ins_code, s.reg_no,
        coalesce(s.url, f.url, 'http://' || r.domain || '/') AS url,
        coalesce(s.site_type, CASE WHEN f.url IS NOT NULL THEN 'TadbirPardaz' END) AS site_type, s.grp
      FROM stored s LEFT JOIN registry r ON r.reg_no = s.reg_no AND r.grp = s.grp
        LEFT JOIN found f ON f.domain = r.domain
    ), new AS (
      SELECT r.l18, r.name, r.type, CASE WHEN r.ins_code IS NOT NULL THEN r.ins_code
        WHEN r.k % 5 <> 0 THEN 'i' || r.k END AS ins_code, r.reg_no, r.grp
      FROM registry r WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.reg_no = r.reg_no)
    ), grown AS (
      SELECT * FROM existing UNION ALL
      SELECT l18, name, type, ins_code, reg_no, NULL, NULL, grp FROM new WHERE ins_code IS NOT NULL
    )
"""


@query(
    "catalog_update",
    _UPDATE
    + """
    SELECT CASE WHEN CAST(substr(ins_code, 2) AS BIGINT) % 5 <> 0 AND CAST(substr(ins_code, 2) AS BIGINT) % 6 = 0
      THEN 'T' || substr(ins_code, 2) ELSE l18 END AS l18,
      name, type, ins_code, reg_no, url, site_type, CAST(grp AS BIGINT) AS group_id
    FROM grown
    """,
)
def catalog_update(t):
    updated = update_catalog(*update_inputs(t)).catalog
    group = F.col("group_id").cast("bigint").alias("group_id")
    return updated.select(
        "l18", "name", "type", "ins_code", "reg_no", "url", "site_type", group
    )


@query("catalog_unresolved", _UPDATE + "SELECT l18, name, reg_no FROM new WHERE ins_code IS NULL")
def catalog_unresolved(t):
    return update_catalog(*update_inputs(t)).unresolved.select("l18", "name", "reg_no")


@query(
    "catalog_not_in_registry",
    "SELECT 'S' || c_custkey AS l18 FROM customer WHERE c_acctbal >= 6000 AND c_custkey % 50 <> 0",
)
def catalog_not_in_registry(t):
    """The registry knows customers of a large balance by another number."""
    result = update_catalog(*update_inputs(t, registered=F.col("c_acctbal") < 6000))
    return result.missing_from_registry.select("l18")


@query(
    "catalog_sorted",
    """
    SELECT row_number() OVER (ORDER BY encode('S' || c_nationkey), encode(CAST(c_custkey AS VARCHAR))) - 1 AS position,
      'S' || c_nationkey AS l18, CAST(c_custkey AS VARCHAR) AS ins_code
    FROM customer
    """,
)
def catalog_sorted(t):
    """The stored order of a catalogue in which few symbols repeat very often, as positions."""
    rows = catalog_of(t.customer, l18=joined_text("S", text_of("c_nationkey")), ins_code=text_of("c_custkey"))
    return catalog_positions(rows).select("position", "l18", "ins_code")
