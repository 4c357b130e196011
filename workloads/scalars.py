"""Scalar functions: calendar, numbers, letters, URLs, page titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlake.functions import jalali, text
from fundlake.operators import sites
from workloads.encode import cents, date_text, fa_commas
from workloads.registry import query


@query(
    "jalali_roundtrip",
    """
    WITH years AS (
      SELECT y, 365 + CASE WHEN y % 33 IN (1,5,9,13,17,22,26,30) THEN 1 ELSE 0 END AS n
      FROM range(1360, 1420) t(y)
    ), starts AS (
      SELECT y, DATE '1981-03-21' + CAST(coalesce(sum(n) OVER (ORDER BY y
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS y0, n
      FROM years
    ), days AS (
      SELECT y, CAST(y0 + CAST(i AS INTEGER) AS DATE) AS d, i
      FROM starts, range(0, 366) r(i) WHERE i < n
    ), calendar AS (
      SELECT d, y,
        CASE WHEN i < 186 THEN i // 31 + 1 ELSE (i - 186) // 30 + 7 END AS m,
        CASE WHEN i < 186 THEN i % 31 + 1 ELSE (i - 186) % 30 + 1 END AS dd
      FROM days
    )
    SELECT strftime(c.d, '%Y-%m-%d') AS day,
      c.y || '/' || lpad(CAST(c.m AS VARCHAR), 2, '0') || '/' || lpad(CAST(c.dd AS VARCHAR), 2, '0') AS padded,
      c.y || '/' || c.m || '/' || c.dd AS unpadded,
      strftime(c.d, '%Y-%m-%d') AS from_padded,
      strftime(c.d, '%Y-%m-%d') AS from_unpadded,
      count(*) AS n_orders
    FROM orders JOIN calendar c ON c.d = CAST(o_orderdate AS DATE)
    GROUP BY ALL
    """,
)
def jalali_roundtrip(t):
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    texts = days.select(
        "d",
        "n_orders",
        jalali.from_date(F.col("d")).alias("padded"),
        jalali.from_date(F.col("d"), padded=False).alias("unpadded"),
    )
    back = texts.select(
        "*",
        jalali.to_date(text.persian_digits(F.col("padded"))).alias("a"),
        jalali.to_date(F.col("unpadded")).alias("b"),
    )
    return back.select(
        date_text("d").alias("day"),
        "padded",
        "unpadded",
        date_text("a").alias("from_padded"),
        date_text("b").alias("from_unpadded"),
        "n_orders",
    )


@query(
    "persian_numbers",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(round(l_extendedprice * 100) AS BIGINT) AS n_cents,
      CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0 AS price,
      CAST(round(l_extendedprice * 100) AS BIGINT) * 1000000007 AS large,
      CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS cut
    FROM lineitem
    """,
)
def persian_numbers(t):
    c = cents("l_extendedprice")
    decimals = text.persian_digits(F.lpad(F.pmod(c, F.lit(100)).cast("string"), 2, "0"))
    whole = fa_commas(F.call_function("div", c, F.lit(100)))
    written = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.concat(F.lit("\n "), fa_commas(c), F.lit(" ")).alias("cents_text"),
        F.concat(F.lit("\t"), whole, F.lit("."), decimals, F.lit(" ")).alias("price_text"),
        fa_commas(c * 1000000007).alias("large_text"),
    )
    return written.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        text.to_whole(F.col("cents_text")).alias("n_cents"),
        text.to_double(F.col("price_text")).alias("price"),
        text.to_bigint(F.col("large_text")).alias("large"),
        text.to_bigint(F.col("price_text")).alias("cut"),
    )


@query(
    "letter_normalise",
    "SELECT p_partkey, translate(p_name, 'ik', 'یک') AS name FROM part",
)
def letter_normalise(t):
    arabic = F.translate("p_name", "ik", "يك")
    return t.part.select("p_partkey", text.normalize_letters(arabic).alias("name")).orderBy(
        F.col("name").asc_nulls_first(), "p_partkey"
    )


@query(
    "page_title",
    """
    SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title,
      length(html) AS n_chars
    FROM pages
    """,
)
def page_title(t):
    return t.pages.select(
        "page_id",
        sites.title(F.col("html")).alias("title"),
        F.length("html").cast("bigint").alias("n_chars"),
    )


@query(
    "url_domain",
    """
    SELECT page_id, nullif(regexp_extract(url, '//([^/]+)/', 1), '') AS domain,
      lower(regexp_extract(url, '^([a-z]+://[^/:?#]+)', 1)) || '/' AS base,
      contains(url, '#') AS has_fragment
    FROM pages
    """,
)
def url_domain(t):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        text.url_domain(url).alias("domain"),
        text.url_base(url).alias("base"),
        text.has_fragment(url).alias("has_fragment"),
    )
