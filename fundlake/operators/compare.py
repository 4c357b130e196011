"""Coverage: symbols that other portals list and the catalogue lacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake import schemas as S
from fundlake.functions.rows import inlined
from fundlake.operators.lookup import lookup_join, one_per_key, unmatched
from fundlake.sources import records
from fundlake.sources.payload import from_json, layout_model

EXCHANGE_SYMBOL = "instrument.lVal18AFC"


def portal_list(responses: DataFrame) -> DataFrame:
    """Fund list of the asset portal: ``(asset_id, name)``."""
    rows = responses.filter(F.col("endpoint") == "etf_list")
    return inlined(rows, [], from_json(F.col("body"), S.ETF_LIST)["data"])


def portal_records(responses: DataFrame) -> DataFrame:
    """The same list with all that the portal sends: ``(asset_id, name, record)``."""
    rows = responses.filter(F.col("endpoint") == "etf_list")
    found = records.open_records(rows, [], F.col("body"), "$.data")
    return found.select(records.field("asset_id", "string").alias("asset_id"), records.field("name", "string").alias("name"), records.RECORD)


def asset_specifications(responses: DataFrame) -> DataFrame:
    """Specification record per asset; ``short_name`` is that of its first instrument."""
    rows = responses.filter(F.col("endpoint") == "asset_spec")
    spec = rows.select(from_json(F.col("body"), S.ASSET_SPECIFICATION)["data"].alias("s"))
    return spec.select(
        F.col("s.asset_id").alias("asset_id"),
        F.col("s.name").alias("asset_name"),
        F.get("s.instruments", F.lit(0))["short_name"].alias("short_name"),
    )


def asset_values(responses: DataFrame) -> DataFrame:
    """Asset pages: the layout record as JSON text, without and with its fund list."""
    rows = responses.filter(F.col("endpoint") == "asset_values")
    return rows.select("url", layout_model(F.col("body")).alias("record"))


def asset_funds(responses: DataFrame, fund: str) -> DataFrame:
    """Fund list nested in the asset pages, with the record schema the caller declares."""
    pages = asset_values(responses)
    funds = from_json(F.col("record"), f"funds array<struct<{fund}>>")["funds"]
    return inlined(pages, ["url"], funds)


def with_short_names(listed: DataFrame, specifications: DataFrame) -> DataFrame:
    """Attach the short name of every listed asset: one join instead of a call per asset."""
    names = one_per_key(specifications.select("asset_id", "short_name"), ["asset_id"])
    return lookup_join(listed, names, ["asset_id"])


def missing_short_names(listed: DataFrame, catalog: DataFrame) -> DataFrame:
    """Short names on the portal that are no catalogue symbol, one row per listed asset."""
    return unmatched(listed.select("short_name"), catalog.select("l18"), "short_name")


def exchange_symbols(feeds: list[DataFrame]) -> DataFrame:
    """Bourse, over-the-counter and commodity feeds as one list of symbols."""
    symbols = [feed.select(F.col(f"`{EXCHANGE_SYMBOL}`").alias("l18")) for feed in feeds]
    return reduce(DataFrame.unionByName, symbols)


def missing_symbols(feeds: list[DataFrame], catalog: DataFrame) -> DataFrame:
    """Distinct exchange symbols that the catalogue lacks.

    Symbols are made distinct first, so a symbol repeated any number of times is one row
    when it meets the catalogue.
    """
    return unmatched(
        exchange_symbols(feeds).distinct(), catalog.select("l18"), "l18", salts=1
    )


def valid_missing(missing: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Missing symbols without those whose description is on the ignore list; null stays."""
    described = lookup_join(
        missing, one_per_key(descriptions.select("l18", "description"), ["l18"]), ["l18"], salts=1
    )
    text = F.col("description")
    return described.filter(text.isNull() | ~text.isin(*C.IGNORED_DESCRIPTIONS))
