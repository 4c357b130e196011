"""Jobs over the entire landing table that step over failed responses."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators import allocation


class FundScan(NamedTuple):
    measures: DataFrame
    quarantine: DataFrame


def scan_cash(responses: DataFrame) -> DataFrame:
    """Cash ratio of every response with its ``outcome``: measured or quarantined."""
    ratios = allocation.cash_ratio(responses)
    outcome = F.when(F.col("error").isNull(), "measured").otherwise("quarantined")
    return ratios.withColumn("outcome", outcome)


def store_cash(responses: DataFrame, path: str) -> None:
    """Run the scan once and store both outcomes, each in its own partition."""
    scan_cash(responses).write.partitionBy("outcome").parquet(path)


def read_scan(spark: SparkSession, path: str) -> FundScan:
    """Measures and quarantine of a stored scan; each reads its own partition."""
    stored = spark.read.parquet(path)
    measured = stored.filter(F.col("outcome") == "measured").drop("error", "outcome")
    quarantined = stored.filter(F.col("outcome") == "quarantined").drop("cash", "outcome")
    return FundScan(measured, quarantined)
