"""Data-quality rules over the catalogue: violations as rows, not as raised errors.

Uniqueness is found by counting, which shrinks repeats before the shuffle; no group is ever
gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import text
from fundlake.functions.rows import inlined
from fundlake.operators.lookup import default_salts, lookup_join, matched, one_per_key

def duplicate_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, value, n)`` for values that occur more than once; nulls equal each other.

    All columns are counted in one grouping, whatever their number.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    counted = inlined(rows, [], pairs).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.filter(F.col("n") > 1)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated key combinations with their count; nulls equal each other."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_rows(rows: DataFrame, keys: list[str], salts: int | None = None) -> DataFrame:
    """The rows whose key combination is repeated, nulls equal each other.

    Keys are counted first; the rows are then looked up in the repeated keys, hot ones
    being spread by salt.
    """
    salts = default_salts(rows) if salts is None else salts
    names = [f"_k{i}" for i in range(len(keys))]
    repeated = duplicate_keys(rows, keys).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_rs"),
    )
    spread = rows.withColumn("_ls", F.pmod(F.spark_partition_id(), F.lit(salts)))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    same.append(F.col("_ls") == F.col("_rs"))
    return spread.join(repeated, same, "left_semi").drop("_ls")


def values_per_key(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Number of distinct values per key, null being a value of its own."""
    pairs = rows.select(key, value).distinct()
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def ids_per_url(catalog: DataFrame) -> DataFrame:
    """Portfolio ids of every URL in long form: ``(url, portfolio_id, n)``, nulls kept.

    The same content as one list per URL, but no list grows with a popular URL.
    """
    return catalog.groupBy("url", "portfolio_id").agg(F.count(F.lit(1)).alias("n"))


def one_per_url(catalog: DataFrame) -> DataFrame:
    """One catalogue row per URL, the one with the smallest symbol."""
    return one_per_key(catalog, ["url"], [F.col("l18")])


def portfolio_mismatches(
    site_portfolios: DataFrame, catalog: DataFrame, checked_urls: DataFrame | None = None
) -> DataFrame:
    """Ids that only the site or only the catalogue has, per checked URL of the catalogue.

    Checked URLs are those with a site portfolio, unless ``checked_urls`` names them; it is
    needed where a site answered with an empty list.

    A URL whose catalogue ids are all null counts as holding ``1``. Both sides are counted
    together per ``(url, portfolio_id)``; facts per URL come from those counts and are
    looked up again, so no set is built and each input is read once.
    """
    on_site, in_catalog = F.col("on_site"), F.col("in_catalog")

    def side(rows, is_site):
        # The same filter on both inputs lets Spark reuse one shuffle for both branches below.
        known = rows.filter(F.col("url").isNotNull())
        return known.select("url", "portfolio_id", F.lit(is_site).alias("on_site"))

    sides = (
        side(catalog, False)
        .unionByName(side(site_portfolios, True))
        .groupBy("url", "portfolio_id")
        .agg(F.bool_or(on_site).alias("on_site"), F.bool_or(~on_site).alias("in_catalog"))
    )
    stored_id = in_catalog & F.col("portfolio_id").isNotNull()
    per_url = sides.groupBy("url").agg(
        F.bool_or(in_catalog).alias("stored"),
        F.bool_or(on_site).alias("checked"),
        (~F.bool_or(stored_id)).alias("only_null"),
        F.bool_or(on_site & F.col("portfolio_id").eqNullSafe("1")).alias("site_has_1"),
    )
    if checked_urls is not None:
        per_url = matched(per_url, checked_urls, "url", salts=1).withColumn("checked", F.lit(True))
    compared = lookup_join(sides, per_url.filter("stored AND checked"), ["url"], "inner")
    is_null = F.col("portfolio_id").isNull()
    differs = (
        F.when(F.col("only_null") & is_null, ~F.col("site_has_1"))
        .when(F.col("only_null"), F.col("portfolio_id") != "1")
        .otherwise(on_site != in_catalog)
    )
    shown = F.when(F.col("only_null") & is_null, "1").otherwise(F.col("portfolio_id"))
    return compared.filter(differs).select(
        "url", shown.alias("portfolio_id"), "on_site", "in_catalog"
    )


def site_type_mismatches(catalog: DataFrame, detected: DataFrame) -> DataFrame:
    """``(l18, url, site_type, detected)`` where the page tells another vendor.

    ``detected`` holds ``(url, site_type)`` from the classified home pages.
    """
    seen = one_per_key(
        detected.select("url", F.col("site_type").alias("detected")).filter(
            F.col("detected").isNotNull()
        ),
        ["url"],
    )
    joined = lookup_join(catalog, seen, ["url"], "inner")
    return joined.filter(F.col("detected") != F.col("site_type")).select(
        "l18", "url", "site_type", "detected"
    )


def reg_no_mismatches(catalog: DataFrame, site_numbers: DataFrame) -> DataFrame:
    """``(l18, reg_no, site_reg_no, rule)`` where the site shows another number or none.

    ``site_numbers`` holds ``(site_type, url, site_reg_no)``, null when the site has none.
    """
    keys = ["site_type", "url"]
    seen = one_per_key(
        site_numbers.select(*keys, "site_reg_no", F.lit(True).alias("_checked")), keys
    )
    joined = lookup_join(catalog, seen, keys, "inner")
    rule = F.when(F.col("site_reg_no").isNull(), F.lit("reg_no missing on site")).when(
        ~F.col("reg_no").eqNullSafe(F.col("site_reg_no")), F.lit("reg_no differs")
    )
    return joined.select("l18", "reg_no", "site_reg_no", rule.alias("rule")).filter(
        F.col("rule").isNotNull()
    )


def _row_rules() -> list[tuple[str, Column, Column]]:
    labels = list(C.FUND_TYPE_LABELS.values())
    return [
        ("url has a fragment", text.has_fragment(F.col("url")), F.col("url")),
        ("unknown type", ~F.col("type").isin(*labels), F.col("type")),
        ("no site_type", F.col("site_type").isNull(), F.col("url")),
        ("no reg_no", F.col("reg_no").isNull(), F.col("url")),
    ]


def row_violations(catalog: DataFrame) -> DataFrame:
    """Rules on single rows, all in one pass; a null satisfies the first two."""
    checks = [
        F.when(
            F.coalesce(broken, F.lit(False)),
            F.struct(
                F.lit(rule).alias("rule"),
                F.col("l18").alias("key"),
                detail.cast("string").alias("detail"),
            ),
        )
        for rule, broken, detail in _row_rules()
    ]
    return inlined(catalog, [], F.array_compact(F.array(*checks)))


def static_violations(catalog: DataFrame) -> DataFrame:
    """All rules that need the catalogue alone, as ``(rule, key, detail)``."""
    count = F.col("n").cast("string")
    values = duplicate_values(catalog, ["l18", "name", "ins_code"]).select(
        F.concat(F.lit("repeated "), F.col("column_name")).alias("rule"),
        F.col("value").alias("key"),
        count.alias("detail"),
    )
    sites = duplicate_keys(catalog, ["url", "portfolio_id"]).select(
        F.lit("repeated url and portfolio_id").alias("rule"),
        F.concat_ws(" ", "url", "portfolio_id").alias("key"),
        count.alias("detail"),
    )
    urls = values_per_key(catalog, "reg_no", "url").filter(F.col("cnt") > 1).select(
        F.lit("several urls for reg_no").alias("rule"),
        F.col("reg_no").alias("key"),
        F.col("cnt").cast("string").alias("detail"),
    )
    return row_violations(catalog).unionByName(values).unionByName(sites).unionByName(urls)
