"""Coverage comparison with other portals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators import compare


def compare_with_portal(responses: DataFrame, catalog: DataFrame) -> DataFrame:
    """Portal funds whose short name is no catalogue symbol."""
    listed = compare.with_short_names(
        compare.portal_list(responses), compare.asset_specifications(responses)
    )
    return compare.missing_short_names(listed, catalog)


def compare_with_exchange(
    feeds: list[DataFrame], catalog: DataFrame, descriptions: DataFrame
) -> DataFrame:
    """Valid exchange symbols missing from the catalogue."""
    return compare.valid_missing(compare.missing_symbols(feeds, catalog), descriptions)


def count_missing(missing: DataFrame) -> DataFrame:
    return missing.agg(F.count(F.lit(1)).alias("n_missing"))
