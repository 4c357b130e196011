"""Jobs that complete single catalogue columns from sites and from the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators import reconcile as R
from fundlake.operators import sites
from fundlake.operators.lookup import lookup_join, one_per_key


def fill_reg_numbers(catalog: DataFrame, responses: DataFrame) -> DataFrame:
    """Fill missing registration numbers from the rows' own sites.

    A site that shows none, or was not captured, leaves the null.
    """
    keys = ["site_type", "url"]
    shown = one_per_key(sites.site_reg_no(responses), keys)
    found = lookup_join(R.without_reg_no(catalog), shown, keys)
    return R.fill_reg_no(catalog, found.select("l18", F.col("site_reg_no").alias("reg_no")))


def set_payout_intervals(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """Payout intervals of the registry's paying funds, by symbol; others keep theirs."""
    return R.set_dps_interval(catalog, R.dividend_intervals(registry))
