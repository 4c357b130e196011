"""Net-asset-value histories of all vendors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import jalali, text
from fundlake.operators import nav as N
from workloads.encode import cents, date_text, fa, fa_commas, html_table, landed
from workloads.registry import query


def us_text(day):
    """``month/day/year`` without padding."""
    return F.date_format(day, "M/d/yyyy")


def chart(series: list) -> F.Column:
    """Chart body: one list of points per series."""
    empty = F.array().cast("array<string>")
    return F.to_json(
        F.array(
            *[
                F.struct(
                    F.lit(f"s{i}").alias("name"),
                    points.alias("List"),
                    empty.alias("SecList"),
                    empty.alias("Items"),
                )
                for i, points in enumerate(series)
            ]
        )
    )


def point(day_text, value):
    return F.struct(day_text.alias("x"), value.cast("double").alias("y"))


def order_chart(t):
    """A three-series chart of four points per order; every tenth one is uneven."""
    day, c, key = F.col("o_orderdate").cast("date"), cents("o_totalprice"), F.col("o_orderkey")

    def points(offset, n=4):
        return F.array(
            *[point(us_text(F.date_add(day, k)), (c + offset + k) / 100) for k in range(n)]
        )

    first = F.when(key % 10 == 0, points(20, 3)).otherwise(points(20))
    return landed(
        t.orders,
        F.when(key % 2 == 0, F.lit(C.TADBIR)).otherwise(F.lit(C.TADBIR_MULTI)),
        F.lit("http://sector.example.ir/"),
        N.CHART,
        chart([first, points(10), points(0)]),
        portfolio_id=key,
    )


_CHART_SQL = """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(k AS INTEGER), '%Y-%m-%d') AS day,
      (CAST(round(o_totalprice * 100) AS BIGINT) + 20 + k) / 100.0 AS creation,
      (CAST(round(o_totalprice * 100) AS BIGINT) + k) / 100.0 AS redemption,
      (CAST(round(o_totalprice * 100) AS BIGINT) + 10 + k) / 100.0 AS statistical
    FROM orders, range(0, 4) r(k) WHERE o_orderkey % 10 <> 0
"""


def _prices(history):
    return history.select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"),
        date_text("date").alias("day"),
        "creation",
        "redemption",
        "statistical",
    )


@query("nav_three_series", _CHART_SQL)
def nav_three_series(t):
    return _prices(N.tadbir_navps(order_chart(t)))


@query(
    "uneven_series",
    """
    SELECT o_orderkey, CAST(3 AS BIGINT) AS n_creation, CAST(4 AS BIGINT) AS n_statistical,
      CAST(4 AS BIGINT) AS n_redemption
    FROM orders WHERE o_orderkey % 10 = 0
    """,
)
def uneven_series(t):
    found = N.uneven_charts(order_chart(t))
    sizes = [F.col(f"n_{n}").cast("bigint").alias(f"n_{n}") for n in ("creation", "statistical", "redemption")]
    return found.select(F.col("portfolio_id").cast("bigint").alias("o_orderkey"), *sizes)


@query(
    "nav_leveraged_full_join",
    """
    WITH p AS (
      SELECT event_id, i, CAST(ts AS DATE) + CAST(k AS INTEGER) AS d,
        (CAST(round(value * 100) AS BIGINT) + i * 10 + k) / 100.0 AS v
      FROM events, range(0, 6) s(i), range(0, 4) r(k) WHERE k <> i % 4
    )
    SELECT event_id, strftime(d, '%Y-%m-%d') AS day, max(v) FILTER (i = 0) AS normal_creation,
      max(v) FILTER (i = 1) AS normal_statistical, max(v) FILTER (i = 2) AS normal_redemption,
      max(v) FILTER (i = 3) AS creation, max(v) FILTER (i = 4) AS redemption, max(v) FILTER (i = 5) AS normal
    FROM p GROUP BY event_id, d
    """,
)
def nav_leveraged_full_join(t):
    joined = N.leveraged_navps(leveraged_charts(t))
    return joined.select(
        F.col("portfolio_id").cast("bigint").alias("event_id"),
        date_text("date").alias("day"),
        *C.LEVERAGED_SERIES,
    )


def leveraged_charts(t):
    """Six series per event: one day missing in each, a repeated day, and a bad date."""
    day, c = F.col("ts").cast("date"), cents("value")
    series = []
    for i in range(6):
        points = [
            point(us_text(F.date_add(day, k)), (c + i * 10 + k) / 100) for k in range(4) if k != i % 4
        ]
        repeated = point(us_text(F.date_add(day, 3 if i % 4 != 3 else 2)), F.lit(-1))
        bad = point(F.lit("no date"), F.lit(-2))
        series.append(F.array(*points, repeated, bad))
    return landed(
        t.events,
        C.TADBIR_LEVERAGED,
        F.lit("http://lever.example.ir/"),
        N.CHART,
        chart(series),
        portfolio_id=F.col("event_id"),
    )


_NAMES = ("normal_creation", "normal_statistical", "normal_redemption", "creation", "redemption", "normal")


def _chained() -> str:
    """Full joins of the six series, one after the other, each reduced to one value a date."""
    steps = ["j0 AS (SELECT event_id, d, v AS c0 FROM u WHERE i = 0)"]
    for i in range(1, 6):
        before = ", ".join(f"c{k}" for k in range(i))
        steps.append(
            f"j{i} AS (SELECT coalesce(j.event_id, s.event_id) AS event_id, coalesce(j.d, s.d) AS d, {before}, s.v AS c{i} "
            f"FROM j{i - 1} j FULL JOIN (SELECT * FROM u WHERE i = {i}) s ON s.event_id = j.event_id AND s.d = j.d)"
        )
    return ", ".join(steps)


@query(
    "nav_leveraged_exact",
    f"""
    WITH p AS (
      SELECT event_id, i, k AS pos, CAST(ts AS DATE) + CAST(k AS INTEGER) AS d,
        (CAST(round(value * 100) AS BIGINT) + i * 10 + k) / 100.0 AS v
      FROM events, range(0, 6) s(i), range(0, 4) r(k) WHERE k <> i % 4
      UNION ALL SELECT event_id, i, 9, NULL, -2.0 FROM events, range(0, 6) s(i)),
    u AS (SELECT event_id, i, d, arg_min(v, pos) AS v FROM p GROUP BY event_id, i, d),
    {_chained()}
    SELECT event_id, strftime(d, '%Y-%m-%d') AS day, {", ".join(f"c{i} AS {n}" for i, n in enumerate(_NAMES))} FROM j5
    """,
)
def nav_leveraged_exact(t):
    """As a chain of full joins would align them: undated points stay, each series for itself."""
    joined = N.leveraged_navps(leveraged_charts(t), undated=True)
    return joined.select(
        F.col("portfolio_id").cast("bigint").alias("event_id"), date_text("date").alias("day"), *C.LEVERAGED_SERIES
    )


@query(
    "nav_leveraged_undated",
    f"""
    SELECT event_id, {list(_NAMES)}[i + 1] AS series, 4 AS pos, 'no date' AS text, -2.0::DOUBLE AS value
    FROM events, range(0, 6) s(i)
    """,
)
def nav_leveraged_undated(t):
    found = N.leveraged_undated(leveraged_charts(t))
    return found.select(F.col("portfolio_id").cast("bigint").alias("event_id"), "series", "pos", "text", "value")


def positional_body():
    """Records whose key names differ by order status."""
    c = cents("o_totalprice")
    values = [jalali.from_date(F.col("o_orderdate").cast("date"), padded=False), c + 9, c, c + 4]

    def record(names):
        return F.to_json(F.array(F.struct(*[v.alias(n) for v, n in zip(values, names)])))

    old = record(["JalaliDate", "PurchaseNAVPerShare", "SellNAVPerShare", "StatisticalNAVPerShare"])
    new = record(["z_date", "purchase", "a_sale", "m_statistical"])
    return F.when(F.col("o_orderstatus") == "P", old).otherwise(new)


_POSITIONAL_SQL = """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
      CAST(round(o_totalprice * 100) AS DOUBLE) + 9 AS creation,
      CAST(round(o_totalprice * 100) AS DOUBLE) AS redemption,
      CAST(round(o_totalprice * 100) AS DOUBLE) + 4 AS statistical
    FROM orders
"""


def positional(t):
    return landed(
        t.orders,
        F.when(F.col("o_orderstatus") == "P", F.lit(C.RAYAN)).otherwise(F.lit(C.RAYAN2)),
        F.lit("http://rayan.example.ir/"),
        N.CHART,
        positional_body(),
        portfolio_id=F.col("o_orderkey"),
    )


@query("nav_positional", _POSITIONAL_SQL)
def nav_positional(t):
    return _prices(N.rayan_navps(positional(t)))


_ONE_DAY_SQL = """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(round(o_totalprice * 100) AS DOUBLE) + 5 AS creation,
      CAST(round(o_totalprice * 100) AS DOUBLE) + 1 AS redemption, {statistical} AS statistical
    FROM orders
"""


@query(
    "navps_all_vendors",
    f"{_CHART_SQL} UNION ALL {_POSITIONAL_SQL} UNION ALL "
    + _ONE_DAY_SQL.format(statistical="CAST(round(o_totalprice * 100) AS DOUBLE) + 2")
    + " UNION ALL "
    + _ONE_DAY_SQL.format(statistical="NULL"),
)
def navps_all_vendors(t):
    vendors = [order_chart(t), positional(t), *one_day_charts(t)]
    return _prices(N.navps_history(reduce(DataFrame.unionByName, vendors)))


def one_day_charts(t):
    """One day of each order as a dated record, and as a leveraged chart of six series."""
    c, key = cents("o_totalprice"), F.col("o_orderkey")
    at = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T12:00:00+03:30"))
    record = F.struct(
        at.alias("date_time"), (c + 5).alias("purchase_price"), (c + 1).alias("redemption_price"), (c + 2).alias("statistical_value")
    )
    dated = F.to_json(F.struct(F.array(record).alias("data")))
    day = us_text(F.col("o_orderdate").cast("date"))
    values = {"creation": c + 5, "redemption": c + 1}
    series = [F.array(point(day, values.get(name, F.lit(0)))) for name in C.LEVERAGED_SERIES]
    url = F.lit("http://one.example.ir/")
    return (
        landed(t.orders, C.MABNA, url, N.CHART, dated, portfolio_id=key),
        landed(t.orders, C.TADBIR_LEVERAGED, url, N.CHART, chart(series), portfolio_id=key),
    )


@query(
    "nav_daily_arrays",
    """
    SELECT o_orderkey, round(o_totalprice * 100) AS nav, strftime(o_orderdate, '%Y-%m-%d') AS day,
      CAST(o_custkey AS DOUBLE) AS creation_navps
    FROM orders
    """,
)
def nav_daily_arrays(t):
    day = jalali.from_date(F.col("o_orderdate").cast("date"))
    body = F.concat(
        F.lit("[["),
        cents("o_totalprice").cast("string"),
        F.lit(',"'),
        day,
        F.lit('",'),
        F.col("o_custkey").cast("string"),
        F.lit("]]"),
    )
    rows = landed(
        t.orders,
        C.RAYAN2,
        F.lit("http://rayan.example.ir/"),
        "nav_history",
        body,
        portfolio_id=F.col("o_orderkey"),
    )
    return N.rayan_daily_nav(rows).select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"),
        "nav",
        date_text("date").alias("day"),
        "creation_navps",
    )


@query(
    "nav_report_21",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_linenumber AS DOUBLE) AS line,
      strftime(l_shipdate, '%Y-%m-%d') AS day, CAST(round(l_extendedprice * 100) AS DOUBLE) AS issue,
      CASE WHEN l_returnflag = 'R' THEN l_quantity END AS redemption,
      CAST(l_partkey AS DOUBLE) AS statistical,
      CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity * 17 END AS remaining,
      CASE WHEN l_linenumber % 3 <> 0 THEN round(l_discount * 100) / 100.0 END AS leverage,
      CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_suppkey AS DOUBLE) END AS investors
    FROM lineitem
    """,
)
def nav_report_21(t):
    """One report row per line item: a third of them short, a third too long, some blank."""
    q, line = F.col("l_quantity").cast("bigint"), F.col("l_linenumber")
    blank = F.when(F.col("l_returnflag") == "R", fa_commas(q)).otherwise(
        F.when(F.col("l_returnflag") == "A", F.lit(" ")).otherwise(F.lit(""))
    )
    head = [
        fa(line),
        text.persian_digits(jalali.from_date(F.col("l_shipdate").cast("date"))),
        F.concat(F.lit(" "), fa_commas(cents("l_extendedprice"))),
        blank,
        fa_commas(F.col("l_partkey")),
    ]
    middle = [F.lit("۰")] * 5
    hundredths = F.lpad(cents("l_discount").cast("string"), 2, "0")
    tail = [
        *[F.lit("۱")] * 6,
        fa_commas(q * 17),
        F.lit(""),
        F.lit("۲"),
        F.concat(F.lit("۰."), text.persian_digits(hundredths)),
        fa_commas(F.col("l_suppkey")),
    ]
    extra = [F.lit("beyond"), F.lit("the end")]
    body = (
        F.when(line % 3 == 0, html_table([head + middle]))
        .when(line % 3 == 1, html_table([head + middle + tail + extra]))
        .otherwise(html_table([head + middle + tail]))
    )
    pages = landed(
        t.lineitem,
        C.TADBIR_LEVERAGED,
        F.lit("http://lever.example.ir/"),
        "nav_history",
        body,
        portfolio_id=F.col("l_orderkey"),
        page=line,
    )
    report = N.nav_report(pages)
    return report.select(
        F.col("portfolio_id").cast("bigint").alias("l_orderkey"),
        F.col("page").cast("bigint").alias("l_linenumber"),
        F.col("Row").alias("line"),
        date_text("date").alias("day"),
        F.col("Issue Price").alias("issue"),
        F.col("Redemption Price").alias("redemption"),
        F.col("Statistical Price").alias("statistical"),
        F.col("Remaining Premium Certificate").alias("remaining"),
        F.col("Leverage Ratio").alias("leverage"),
        F.col("Number of Normal Unit Investors").alias("investors"),
    )


def iso_tehran(ts):
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:30"))


@query(
    "tehran_dates",
    """
    SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 210 MINUTE, '%Y-%m-%d %H:%M:%S') AS instant,
      strftime(ts, '%Y-%m-%d') AS day, CAST(round(value * 100) AS DOUBLE) + 2 AS creation,
      CAST(round(value * 100) AS DOUBLE) AS redemption, value AS common_price,
      event_id * 10 AS total_unit_count
    FROM events
    """,
)
def tehran_dates(t):
    c = cents("value")
    record = F.struct(
        iso_tehran(F.col("ts")).alias("date_time"),
        (F.col("event_id") * 10).alias("total_unit_count"),
        (c + 2).alias("purchase_price"),
        c.alias("redemption_price"),
        F.col("value").alias("common_unit_purchase_price"),
        (c + 1).alias("statistical_value"),
    )
    rows = landed(
        t.events,
        C.MABNA,
        F.lit("http://mabna.example.ir/"),
        N.CHART,
        F.to_json(F.struct(F.array(record).alias("data"))),
        portfolio_id=F.col("event_id"),
    )
    return N.mabna_navps(rows).select(
        F.col("portfolio_id").cast("bigint").alias("event_id"),
        F.date_format("date_time", "yyyy-MM-dd HH:mm:ss").alias("instant"),
        date_text("date").alias("day"),
        "creation",
        "redemption",
        F.col("common_unit_purchase_price").alias("common_price"),
        "total_unit_count",
    )


@query(
    "assets_history",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CAST(round(value * 100) AS BIGINT) AS total
    FROM events
    """,
)
def assets_history(t):
    record = F.struct(iso_tehran(F.col("ts")).alias("date_time"), cents("value").alias("value"))
    rows = landed(
        t.events,
        C.MABNA,
        F.lit("http://mabna.example.ir/"),
        "assets_history",
        F.to_json(F.struct(F.array(record).alias("data"))),
        portfolio_id=F.col("event_id"),
    )
    return N.mabna_assets(rows).select(
        F.col("portfolio_id").cast("bigint").alias("event_id"),
        date_text("date").alias("day"),
        F.col("value").alias("total"),
    )


@query(
    "price_order",
    """
    SELECT o_orderkey, CAST(round(o_totalprice * 100) AS DOUBLE) + 9 AS creation,
      CAST(round(o_totalprice * 100) AS DOUBLE) + o_custkey % 13 AS redemption
    FROM orders WHERE o_custkey % 13 > 9
    """,
)
def price_order(t):
    c = cents("o_totalprice")
    day = jalali.from_date(F.col("o_orderdate").cast("date"))
    record = F.struct(
        day.alias("d"),
        (c + 9).alias("p"),
        (c + F.col("o_custkey") % 13).alias("s"),
        c.alias("v"),
    )
    rows = landed(
        t.orders,
        C.RAYAN2,
        F.lit("http://rayan.example.ir/"),
        N.CHART,
        F.to_json(F.array(record)),
        portfolio_id=F.col("o_orderkey"),
    )
    wrong = N.price_violations(N.rayan_navps(rows))
    return wrong.select(
        F.col("portfolio_id").cast("bigint").alias("o_orderkey"), "creation", "redemption"
    )
