"""Tabular sources and sinks: the catalogue and the outside feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions import text
from fundlake.operators.positions import positioned
from fundlake.schemas import CATALOG, CATALOG_COLUMNS, REGISTRY
from fundlake.sources.landing import portfolio_or_default

_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "encoding": "UTF-8",
}
# Stands for a quoted empty field while reading, which Spark would take for a missing one.
_EMPTY = chr(0xE000)
_BOM = chr(0xFEFF)
_ROWS_PER_FILE = 1_000_000


def with_site(catalog: DataFrame) -> DataFrame:
    """Add the site key of every row that has a vendor; others get null."""
    portfolio = portfolio_or_default(F.col("portfolio_id"), F.col("site_type"))
    site = F.struct("site_type", "url", portfolio.alias("portfolio_id"))
    return catalog.withColumn("site", F.when(F.col("site_type").isNotNull(), site))


def scan_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV (one file or a folder of them) with its declared schema.

    Quoted fields may contain line breaks, so a file is read by one task; the files that
    ``sink_catalog_csv`` writes are bounded for that reason. A byte-order mark at the start is skipped. A
    missing field is null, a quoted empty one is an empty string.
    """
    rows = spark.read.schema(CATALOG).options(**_CSV, multiLine="true", emptyValue=_EMPTY).csv(path)
    return rows.select(
        *[
            F.when(F.col(name) == _EMPTY, "").otherwise(F.col(name)).alias(name)
            if kind == "string"
            else F.col(name)
            for name, kind in rows.dtypes
        ]
    )


def scan_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG).parquet(path)


def _stored_columns(catalog: DataFrame) -> DataFrame:
    letters = {name: text.normalize_letters(F.col(name)) for name in ("l18", "name")}
    types = dict(f.split() for f in CATALOG.split(", "))
    return catalog.select(
        *[letters.get(c, F.col(c)).cast(types[c]).alias(c) for c in CATALOG_COLUMNS]
    )


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("l18", "ins_code", "reg_no", "url", "portfolio_id", "name")]


def catalog_rows(catalog: DataFrame) -> DataFrame:
    """Catalogue ready to be stored: Persian letters, ten columns, sorted by symbol.

    Rows of one symbol are ordered by their other columns too, so that the range sort can
    split a symbol that fills more than one partition.
    """
    return _stored_columns(catalog).orderBy(*_order())


def catalog_positions(catalog: DataFrame) -> DataFrame:
    """The rows of ``catalog_rows`` with their ``position`` in that order, from 0; equal rows take neighbouring ones."""
    return positioned(_stored_columns(catalog), _order())


def sink_catalog(catalog: DataFrame, path: str) -> None:
    """Write a new version of the catalogue; the path must be a fresh one."""
    catalog_rows(catalog).write.parquet(path)


def sink_catalog_csv(catalog: DataFrame, path: str, bom: bool = True) -> None:
    """Write the catalogue as CSV files of bounded size, each with its own header.

    With ``bom`` the first header name carries the mark, so every file begins with it.
    """
    rows = catalog_rows(catalog)
    if bom:
        first, *others = rows.columns
        rows = rows.toDF(_BOM + first, *others)
    writer = rows.write.options(
        **_CSV,
        emptyValue='""',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
        maxRecordsPerFile=str(_ROWS_PER_FILE),
    )
    writer.csv(path)


def resort_catalog_csv(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite a catalogue CSV sorted, into a new folder."""
    sink_catalog_csv(scan_catalog_csv(spark, source), target)


def scan_registry(spark: SparkSession, path: str) -> DataFrame:
    """Fund-registry feed in its own column names."""
    return spark.read.schema(REGISTRY).parquet(path)


def scan_feed(spark: SparkSession, path: str) -> DataFrame:
    """A feed that arrives as Parquet with its own columns (instruments, exchange lists)."""
    return spark.read.parquet(path)


def sink_unresolved(unresolved: DataFrame, path: str) -> None:
    """Report of the funds that could not be added."""
    unresolved.write.parquet(path)
