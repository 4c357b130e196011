"""Encoding of table rows as landed responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.text import persian_digits


def fa(c: Column) -> Column:
    return persian_digits(c.cast("string"))


def fa_commas(c: Column) -> Column:
    """Whole number with Persian digits and thousands separators."""
    return persian_digits(F.format_number(c, 0))


def cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


def json_text(text: Column) -> Column:
    """Text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def html_table(rows: list[list[Column]], before: str = "", after: str = "") -> Column:
    """Report page with the given cells."""
    trs = [
        F.concat(*[part for cell in row for part in (F.lit("\n<td>"), cell, F.lit("</td>"))])
        for row in rows
    ]
    body = F.concat_ws("\n</tr>\n   <tr>", *trs)
    return F.concat(
        F.lit(f"<html>{before}<table><thead><tr><th>x</th></tr></thead><tbody>\n<tr>"),
        body,
        F.lit(f"</tr>\n</tbody></table>{after}</html>"),
    )


def landed(
    rows: DataFrame,
    vendor: Column | str,
    url: Column,
    endpoint: Column | str,
    body: Column,
    portfolio_id: Column | str = "1",
    page: Column | int = 1,
    at: Column | None = None,
) -> DataFrame:
    """Landing-table rows, one per input row."""

    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return rows.select(
        column(vendor).alias("site_type"),
        url.alias("url"),
        column(portfolio_id).cast("string").alias("portfolio_id"),
        column(endpoint).alias("endpoint"),
        column(page).cast("int").alias("page"),
        F.lit(200).alias("status"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") if at is None else at).alias("fetched_at"),
        body.alias("body"),
    )


def site_url(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"http://{kind}"), F.col(key).cast("string"), F.lit(".example.ir/"))


def date_text(name: str) -> Column:
    """Date as ISO text, the form in which results are compared."""
    return F.date_format(F.col(name), "yyyy-MM-dd")


def time_text(name: str) -> Column:
    return F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss")
