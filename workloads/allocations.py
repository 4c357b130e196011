"""Asset allocation, cash ratio, leverage, industries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import jalali
from fundlake.operators import allocation as A
from fundlake.operators.sites import home_states
from fundlake.plans.scan_funds import scan_cash
from workloads.encode import cents, json_text, landed, site_url
from workloads.quotes import leveraged_body
from workloads.registry import query

_STRANGE = "چیز دیگر"


def percents(more=0):
    """Three percentages with two decimals from the columns of an order, and the rest."""
    a = F.pmod(cents("o_totalprice"), F.lit(5000))
    b = F.pmod(F.col("o_custkey"), F.lit(2000))
    c = F.pmod(F.col("o_orderkey"), F.lit(3000))
    return [x.cast("double") / 100 for x in (a, b, c, 10000 - a - b - c + more)]


def order_vendor():
    kind = F.col("o_orderkey") % 4
    return (
        F.when(kind == 0, F.lit(C.TADBIR))
        .when(kind == 1, F.lit(C.MABNA))
        .when(kind == 2, F.lit(C.RAYAN2))
        .otherwise(F.lit(C.RAYAN))
    )


def allocation_body(more=0):
    """Allocation in the vendor's form. One vendor repeats an item: the last weight counts."""
    a, b, c, rest = percents(more)

    def entries(names, title, value):
        return [F.struct(F.lit(n).alias(title), v.alias(value)) for n, v in names]

    listed = F.array(
        *entries(
            [
                (C.TADBIR_CASH[0], F.lit(99.0)),
                (C.TADBIR_CASH[0], a),
                (C.TADBIR_CASH[2], b),
                ("سایر سهام", c),
                (_STRANGE, rest),
            ],
            "x",
            "y",
        )
    )
    tadbir = F.to_json(F.struct(F.lit("").alias("name"), listed.alias("List")))
    assets = F.array(
        *entries(
            [(C.MABNA_CASH[1], a), (C.MABNA_CASH[0], b), ("سهام", c), ("سایر", rest)],
            "title",
            "percentage",
        )
    )
    mabna = F.to_json(F.struct(F.struct(assets.alias("assets")).alias("data")))
    day = jalali.from_date(F.col("o_orderdate").cast("date"))

    def wide(names, date_name):
        fields = [v.alias(n) for n, v in zip(names, (a, b, c))]
        other = rest.alias("OtherStock" if names == C.RAYAN_CASH else "otherStock")
        return F.to_json(F.struct(*fields, other, day.alias(date_name)))

    kind = F.col("o_orderkey") % 4
    return (
        F.when(kind == 0, tadbir)
        .when(kind == 1, mabna)
        .when(kind == 2, wide(C.RAYAN2_CASH, "jalaliDate"))
        .otherwise(wide(C.RAYAN_CASH, "JalaliDate"))
    )


def order_allocations(t, broken: bool = False, more=0):
    body = allocation_body(more)
    if broken:
        body = F.when(F.col("o_orderkey") % 11 == 0, F.lit('{"oops')).otherwise(body)
    return landed(
        t.orders,
        order_vendor(),
        F.lit("http://hot.example.ir/"),
        A.ENDPOINT,
        body,
        portfolio_id=F.col("o_orderkey"),
    )


_PARTS = """
    SELECT o_orderkey, o_orderkey % 4 AS kind, CAST(round(o_totalprice * 100) AS BIGINT) % 5000 AS a,
      o_custkey % 2000 AS b, o_orderkey % 3000 AS c, strftime(o_orderdate, '%Y-%m-%d') AS day
    FROM orders
"""


@query(
    "allocation_long",
    f"""
    WITH p AS ({_PARTS}), long AS (
      SELECT o_orderkey, kind, day, unnest([1, 2, 3, 4]) AS i, unnest([a, b, c, 10000 - a - b - c]) AS v FROM p
    )
    SELECT o_orderkey, v / 100.0 / 100 AS weight,
      CASE kind
        WHEN 0 THEN CASE i WHEN 1 THEN 'نقد و بانک (سپرده)' WHEN 2 THEN 'اوراق مشارکت' WHEN 3 THEN 'سایر سهام' ELSE 'چیز دیگر' END
        WHEN 1 THEN CASE i WHEN 1 THEN 'وجه نقد' WHEN 2 THEN 'اوراق' WHEN 3 THEN 'سهام' ELSE 'سایر' END
        WHEN 2 THEN CASE i WHEN 1 THEN 'depositTodayPercent' WHEN 2 THEN 'cashTodayPercent' WHEN 3 THEN 'bondTodayPercent' ELSE 'otherStock' END
        ELSE CASE i WHEN 1 THEN 'DepositTodayPercent' WHEN 2 THEN 'CashTodayPercent' WHEN 3 THEN 'BondTodayPercent' ELSE 'OtherStock' END
      END AS item,
      NOT (kind = 0 AND i = 4) AS known,
      CASE WHEN kind >= 2 THEN day END AS as_of
    FROM long
    """,
)
def allocation_long(t):
    return A.allocation(order_allocations(t)).select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"),
        "weight",
        "item",
        "known",
        F.date_format("as_of", "yyyy-MM-dd").alias("as_of"),
    )


@query(
    "allocation_unknown",
    "SELECT o_orderkey, 'چیز دیگر' AS item FROM orders WHERE o_orderkey % 4 = 0",
)
def allocation_unknown(t):
    return A.unknown_items(order_allocations(t)).select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"), "item"
    )


@query(
    "weights_off_one",
    "SELECT o_orderkey, CAST(100 + o_orderkey % 7 AS BIGINT) AS percent FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0",
)
def weights_off_one(t):
    """Some orders hold too much of one item; an item that one vendor repeats counts once."""
    more = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") % 7 * 100).otherwise(0)
    found = A.weight_violations(order_allocations(t, more=more))
    return found.select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"),
        F.round(F.col("total") * 100).cast("bigint").alias("percent"),
    )


_CASH = """
    CASE kind WHEN 0 THEN a / 100.0 / 100 + 0.0 + b / 100.0 / 100
      WHEN 1 THEN b / 100.0 / 100 + a / 100.0 / 100 + 0.0
      ELSE a / 100.0 / 100 + b / 100.0 / 100 + c / 100.0 / 100 END
"""


@query(
    "cash_ratio",
    f"""
    WITH p AS ({_PARTS})
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN {_CASH} END AS cash,
      CASE WHEN o_orderkey % 11 = 0 THEN 'unreadable body' END AS error
    FROM p
    """,
)
def cash_ratio(t):
    return A.cash_ratio(order_allocations(t, broken=True)).select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"), "cash", "error"
    )


@query(
    "cash_scan_counts",
    """
    SELECT 'measured' AS outcome, count(*) AS n FROM orders WHERE o_orderkey % 11 <> 0
    UNION ALL SELECT 'quarantined', count(*) FROM orders WHERE o_orderkey % 11 = 0
    """,
)
def cash_scan_counts(t):
    return scan_cash(order_allocations(t, broken=True)).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "leverage_plain",
    f"""
    WITH p AS ({_PARTS}), m AS (SELECT o_orderkey, kind, {_CASH} AS cash FROM p)
    SELECT o_orderkey, cash, CASE WHEN kind <> 1 THEN (1.0 + 0.0) * (1.0 - cash) END AS leverage
    FROM m
    """,
)
def leverage_plain(t):
    """One vendor's funds have no leverage here, for lack of their home pages."""
    return A.leverage(order_allocations(t)).select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"), "cash", "leverage"
    )


def customer_allocation(key):
    """Listed allocation with a tenth of the key's last two digits as cash."""
    cash = F.pmod(F.col(key), F.lit(100)).cast("double") / 10
    return cash


@query(
    "leverage_leveraged",
    """
    SELECT c_custkey, (c_custkey % 100) / 10.0 / 100 + 0.0 + 0.0 AS cash,
      (1.0 + (c_custkey * 2 + 1.25) / CAST(c_custkey + 16 AS DOUBLE))
        * (1.0 - ((c_custkey % 100) / 10.0 / 100 + 0.0 + 0.0)) AS leverage
    FROM customer
    """,
)
def leverage_leveraged(t):
    customers = t.customer
    entry = F.struct(
        F.lit(C.TADBIR_CASH[0]).alias("x"), customer_allocation("c_custkey").alias("y")
    )
    allocations = landed(
        customers,
        C.TADBIR_LEVERAGED,
        site_url("lever", "c_custkey"),
        A.ENDPOINT,
        F.to_json(F.struct(F.array(entry).alias("List"))),
        portfolio_id="",
    )
    quotes = landed(
        customers,
        C.TADBIR_LEVERAGED,
        site_url("lever", "c_custkey"),
        "live_navps",
        leveraged_body("c_custkey", "c_acctbal"),
        portfolio_id="",
    )
    measured = A.leverage(allocations.unionByName(quotes))
    return measured.select(
        F.regexp_extract("url", r"lever(\d+)", 1).cast("bigint").alias("c_custkey"),
        "cash",
        "leverage",
    )


def state_page(key):
    """Home page with script state; amounts in the tenth query, or for some in the third."""
    k = F.col(key)
    leveraged = (k % 3 != 0).cast("string")
    amounts = F.to_json(
        F.create_map(
            F.lit("first"),
            F.struct(
                (k * 3 + 1).alias("commonUnitRedemptionValueAmount"),
                (k + 8).alias("preferredUnitRedemptionValueAmount"),
            ),
        )
    )
    empty = '{"state":{"data":{"a":{"b":1}}}}'
    holder = F.concat(F.lit('{"state":{"data":'), amounts, F.lit("}}"))
    tenth = F.concat_ws(",", *[F.lit(empty)] * 9, holder)
    third = F.concat_ws(",", F.lit(empty), F.lit('{"state":{"data":[1]}}'), holder)
    queries = F.concat(
        F.lit('{"mutations":[],"queries":['), F.when(k % 5 == 0, third).otherwise(tenth), F.lit("]}")
    )
    redux = F.concat(F.lit('{"general":{"data":{"isLeverage":'), leveraged, F.lit("}}}"))
    return F.concat(
        F.lit("<html><script>\nwindow.__REACT_QUERY_STATE__ = "),
        json_text(queries),
        F.lit(";\nwindow.__REACT_REDUX_STATE__ = "),
        json_text(redux),
        F.lit(';\nwindow.__ENV__ = "{\\"VITE_API_PREFIX\\":\\"x\\"}"\n</script></html>'),
    )


@query(
    "leverage_state_blob",
    """
    WITH m AS (SELECT c_custkey, 0.0 + (c_custkey % 100) / 10.0 / 100 + 0.0 AS cash FROM customer)
    SELECT c_custkey, cash, (1.0 + CASE WHEN c_custkey % 3 = 0 THEN 0.0
      ELSE CAST(c_custkey * 3 + 1 AS DOUBLE) / CAST(c_custkey + 8 AS DOUBLE) END) * (1.0 - cash) AS leverage
    FROM m
    """,
)
def leverage_state_blob(t):
    customers = t.customer
    entry = F.struct(
        F.lit(C.MABNA_CASH[1]).alias("title"), customer_allocation("c_custkey").alias("percentage")
    )
    assets = F.struct(F.struct(F.array(entry).alias("assets")).alias("data"))
    url = site_url("mabna", "c_custkey")
    allocations = landed(customers, C.MABNA, url, A.ENDPOINT, F.to_json(assets))
    homes = landed(customers, C.MABNA, url, "home", state_page("c_custkey"))
    measured = A.leverage(allocations.unionByName(homes))
    return measured.select(
        F.regexp_extract("url", r"mabna(\d+)", 1).cast("bigint").alias("c_custkey"),
        "cash",
        "leverage",
    )


@query(
    "home_state_blobs",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'false' ELSE 'true' END AS is_leverage,
      '{"VITE_API_PREFIX":"x"}' AS env, CAST(CASE WHEN c_custkey % 5 = 0 THEN 3 ELSE 10 END AS BIGINT) AS n_queries
    FROM customer
    """,
)
def home_state_blobs(t):
    url = site_url("mabna", "c_custkey")
    states = home_states(landed(t.customer, C.MABNA, url, "home", state_page("c_custkey")))
    return states.select(
        F.regexp_extract("url", r"mabna(\d+)", 1).cast("bigint").alias("c_custkey"),
        F.get_json_object("redux_state", "$.general.data.isLeverage").alias("is_leverage"),
        "env",
        F.json_array_length(F.get_json_object("query_state", "$.queries"))
        .cast("bigint")
        .alias("n_queries"),
    )


@query(
    "industries",
    """
    SELECT s_suppkey, s_name AS industry, CAST(round(s_acctbal * 100) AS DOUBLE) / 100.0 AS percentage,
      CASE WHEN s_suppkey % 2 = 0 THEN 'RayanHamafza2' ELSE 'MabnaDP2' END AS site_type
    FROM supplier
    """,
)
def industries(t):
    return A.industries(industry_responses(t)).select(
        F.col("portfolio_id").cast("bigint").alias("s_suppkey"), "industry", "percentage", "site_type"
    )


@query(
    "industry_table",
    """
    SELECT s_suppkey, s_name AS name, CAST(round(s_acctbal * 100) AS DOUBLE) / 100.0 AS share
    FROM supplier WHERE s_suppkey % 2 = 0
    """,
)
def industry_table(t):
    """The payload of one vendor as it comes, with a declared record."""
    rows = A.industry_records(industry_responses(t), "industryName: string, share: double")
    return rows.select(
        F.col("portfolio_id").cast("bigint").alias("s_suppkey"),
        F.col("industryName").alias("name"),
        "share",
    )


def industry_responses(t):
    """Suppliers as funds of two vendors, one of which embeds industries in its allocation."""
    even = F.col("s_suppkey") % 2 == 0
    share = cents("s_acctbal").cast("double") / 100
    record = F.struct(F.col("s_name").alias("title"), share.alias("percentage"))
    own = F.to_json(
        F.array(F.struct(F.col("s_name").alias("industryName"), share.alias("share")))
    )
    embedded = F.to_json(F.struct(F.struct(F.array(record).alias("industries")).alias("data")))
    return landed(
        t.supplier,
        F.when(even, C.RAYAN2).otherwise(C.MABNA),
        F.lit("http://industry.example.ir/"),
        F.when(even, "industries").otherwise(A.ENDPOINT),
        F.when(even, own).otherwise(embedded),
        portfolio_id=F.col("s_suppkey"),
    )
