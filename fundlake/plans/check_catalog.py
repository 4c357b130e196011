"""Catalogue check, end to end: every rule is evaluated, violations are rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators import quality as Q
from fundlake.operators import reconcile as R
from fundlake.operators import sites
from fundlake.session import stored


class CatalogCheck(NamedTuple):
    violations: DataFrame
    corrected: DataFrame


def check_static(catalog: DataFrame) -> DataFrame:
    return Q.static_violations(catalog)


def check_live(catalog: DataFrame, responses: DataFrame) -> CatalogCheck:
    """Static rules, then stored values against landed sites.

    Returns the violations ``(rule, key, detail)`` and the catalogue with vendor types
    corrected to the detected ones. Page bodies are read once, into a stored summary that
    all live rules share.
    """
    summary = stored(sites.site_summary(responses), "site-summary")
    detected = sites.summary_detected(summary)
    types = Q.site_type_mismatches(catalog, detected)
    numbers = Q.reg_no_mismatches(catalog, sites.summary_reg_no(summary))
    ids = Q.portfolio_mismatches(sites.summary_portfolios(summary), catalog, sites.summary_listed(summary))
    no_site = catalog.filter(F.col("site_type").isNull())
    unclassified = detected.filter(F.col("site_type").isNull())

    parts = [
        types.select(
            F.lit("other vendor detected").alias("rule"),
            F.col("l18").alias("key"),
            F.concat_ws(" -> ", "site_type", "detected").alias("detail"),
        ),
        numbers.select(
            "rule",
            F.col("l18").alias("key"),
            F.concat_ws(" / ", "reg_no", "site_reg_no").alias("detail"),
        ),
        ids.select(
            F.when(F.col("on_site"), F.lit("portfolio not in catalogue"))
            .otherwise(F.lit("portfolio not on site"))
            .alias("rule"),
            F.col("url").alias("key"),
            F.col("portfolio_id").alias("detail"),
        ),
        no_site.select(
            F.lit("no site").alias("rule"), F.col("l18").alias("key"), F.col("url").alias("detail")
        ),
        unclassified.select(
            F.lit("unknown vendor").alias("rule"),
            F.col("url").alias("key"),
            F.lit(None).cast("string").alias("detail"),
        ),
    ]
    violations = check_static(catalog)
    for part in parts:
        violations = violations.unionByName(part)
    corrections = types.select("l18", F.col("detected").alias("site_type"))
    return CatalogCheck(violations, R.correct_site_type(catalog, corrections))


class CatalogError(ValueError):
    """Raised in strict runs when the written violations are not empty."""


def require_clean(violations: DataFrame) -> None:
    """Fail a strict run; call it on the written violations table."""
    if not violations.isEmpty():
        raise CatalogError("the catalogue breaks at least one rule")
