"""The landing table of captured responses: the input of every site operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.schemas import KEY, RESPONSES


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Parquet landing table, partitioned by ``endpoint`` so that jobs read only theirs."""
    return spark.read.schema(RESPONSES).parquet(path)


def write_responses(responses: DataFrame, path: str) -> None:
    responses.write.partitionBy("endpoint").mode("append").parquet(path)


def captured(responses: DataFrame, endpoint: str, vendors: list[str] | None = None) -> DataFrame:
    """Successful responses of one endpoint; both filters reach the Parquet scan."""
    rows = responses.filter(
        (F.col("endpoint") == endpoint) & F.col("status").between(200, 299)
    )
    return rows if vendors is None else rows.filter(F.col("site_type").isin(*vendors))


def latest_capture(
    responses: DataFrame, endpoint: str | None = None, vendors: list[str] | None = None
) -> DataFrame:
    """Keep the newest successful capture per fund, endpoint and page.

    A failed fetch never hides an earlier answer. Of equal times one capture stays, chosen by the
    hash of its answer. The responses are read once and not joined with themselves, so no fund is
    lost where two reads differ; of a task's captures one body per key crosses the shuffle.
    ``endpoint`` and ``vendors`` limit what the scan reads.
    """
    keys = [*KEY, "endpoint", "page"]
    rows = responses.filter(F.col("status").between(200, 299))
    if endpoint is not None:
        rows = rows.filter(F.col("endpoint") == endpoint)
    if vendors is not None:
        rows = rows.filter(F.col("site_type").isin(*vendors))
    order = F.struct("fetched_at", F.xxhash64("status", "body"))
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("_newest"))
    return newest.select("_newest.*")


def portfolio_or_default(portfolio_id: Column, site_type: Column) -> Column:
    """Portfolio of a catalogue row; null and blank mean the vendor's default."""
    default = F.lit("")
    for vendor, portfolio in C.DEFAULT_PORTFOLIO.items():
        default = F.when(site_type == vendor, F.lit(portfolio)).otherwise(default)
    return F.coalesce(F.nullif(portfolio_id, F.lit("")), default)


def for_portfolio(responses: DataFrame, portfolio_id: str) -> DataFrame:
    """Responses of one portfolio, the vendor default standing in for a missing id."""
    actual = portfolio_or_default(F.col("portfolio_id"), F.col("site_type"))
    return responses.filter(actual == portfolio_id)


def incomplete_reports(pages: DataFrame) -> DataFrame:
    """Paged reports that lack pages: gaps in 1..n, or a last page that names a next one.

    A page whose fetch failed is missing. Each body shrinks to one boolean before the shuffle.
    A report of which every page failed is not listed: nothing tells that it has pages.
    """
    has_next = F.col("body").contains(C.NEXT_PAGE_TITLE)
    per_report = (
        pages.filter(F.col("status").between(200, 299))
        .select(*KEY, "endpoint", "page", has_next.alias("has_next"))
        .groupBy(*KEY, "endpoint")
        .agg(
            F.min("page").alias("first_page"),
            F.max("page").alias("last_page"),
            F.count_distinct("page").alias("n_pages"),
            F.max_by("has_next", "page").alias("continues"),
        )
    )
    return per_report.filter(
        (F.col("first_page") != 1)
        | (F.col("last_page") != F.col("n_pages"))
        | F.col("continues")
    )


def status_error() -> Column:
    """Reason why a response counts as failed; null for a successful one."""
    code = F.coalesce(F.col("status").cast("string"), F.lit("unknown"))
    return F.when(~F.coalesce(F.col("status").between(200, 299), F.lit(False)), F.concat(F.lit("status "), code))
