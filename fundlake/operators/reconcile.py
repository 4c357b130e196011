"""Catalogue reconciliation: registry, probed sites and exchange instruments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import text
from fundlake.operators.lookup import lookup_join, one_per_key, unmatched, with_value
from fundlake.sources.lookups import HOT_SHARE, Lookup, lookup_values, store_lookup


def type_label(code: Column) -> Column:
    """Label of a registry fund type; an unknown code stays as its own text."""
    labels = F.create_map(*[F.lit(v) for pair in C.FUND_TYPE_LABELS.items() for v in pair])
    return F.coalesce(F.try_element_at(labels, code), code.cast("string"))


def registry_funds(registry: DataFrame) -> DataFrame:
    """Negotiable, completed, exchange-traded funds of the registry in catalogue terms."""
    kept = registry.filter(
        (F.col("typeOfInvest") == "Negotiable")
        & ~F.col("fundType").isin(*C.EXCLUDED_FUND_TYPES)
        & F.col("isCompleted")
    )
    return kept.select(
        F.col("regNo").alias("reg_no"),
        F.col("smallSymbolName").alias("l18"),
        "name",
        type_label(F.col("fundType")).alias("type"),
        F.col("websiteAddress").alias("domain"),
        F.col("insCode").alias("ins_code"),
        F.col("groupId").cast("int").alias("group_id"),
    )


def dividend_intervals(registry: DataFrame) -> DataFrame:
    """``(l18, dps_interval)`` of negotiable funds that pay out periodically."""
    paying = registry.filter(
        (F.col("dividendIntervalPeriod") > 0) & (F.col("typeOfInvest") == "Negotiable")
    )
    return paying.select(
        F.col("smallSymbolName").alias("l18"), F.col("dividendIntervalPeriod").alias("dps_interval")
    )


def missing_from_registry(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """Catalogue rows with a registration number that the unfiltered registry lacks."""
    return unmatched(catalog, registry.select("regNo"), "reg_no", keep_null=False)


def new_funds(funds: DataFrame, catalog: DataFrame) -> DataFrame:
    """Registry funds whose registration number the catalogue lacks."""
    return unmatched(funds, catalog.select("reg_no"), "reg_no", keep_null=False)


def domains_to_probe(
    funds: DataFrame, catalog: DataFrame, update_existing: bool = False
) -> DataFrame:
    """Distinct registry domains that still need a look at their site."""
    wanted = funds.select("domain").filter(F.col("domain").isNotNull()).distinct()
    if update_existing:
        return wanted
    known = catalog.select(text.url_domain(F.col("url")).alias("domain"))
    return unmatched(wanted, known, "domain", salts=1)


def add_site(
    funds: DataFrame, probes: DataFrame, catalog: DataFrame, update_existing: bool = False
) -> DataFrame:
    """Registry funds with ``url`` and ``site_type`` of their probed domain.

    Domains the catalogue already knows are not probed again and get nulls, unless
    ``update_existing``. Probe results and known domains form one lookup by domain, so the
    funds are joined once.
    """
    found = one_per_key(probes.select("domain", "url", "site_type"), ["domain"])
    if not update_existing:
        known = catalog.select(text.url_domain(F.col("url")).alias("domain"))
        found = unmatched(found, known, "domain", salts=1)
    return lookup_join(funds, found, ["domain"])


def update_from_registry(catalog: DataFrame, funds: DataFrame) -> DataFrame:
    """Catalogue ⟕ registry by ``(reg_no, group_id)``.

    ``url`` and ``site_type`` of the catalogue win, ``type`` of the registry wins, and a
    missing URL is built from the registry's domain. Repeated registry keys count once, so
    the number of catalogue rows stays.
    """
    keys = ["reg_no", "group_id"]
    fields = ["domain", "type", "url", "site_type"]
    renamed = funds.select(
        "reg_no", F.col("group_id").cast("int"), *[F.col(f).alias(f"new_{f}") for f in fields]
    )
    lookup = one_per_key(renamed, keys, [F.col("new_url").isNull(), F.col("new_domain").isNull()])
    joined = lookup_join(catalog.withColumn("group_id", F.col("group_id").cast("int")), lookup, keys)
    domain = F.col("new_domain")
    url = F.coalesce("url", "new_url")
    from_domain = F.concat(F.lit("http://"), domain, F.lit("/"))
    merged = {
        "type": F.coalesce("new_type", "type"),
        "url": F.coalesce(url, from_domain),
        "site_type": F.coalesce("site_type", "new_site_type"),
    }
    return joined.select(
        *[
            merged[name].alias(name) if name in merged else F.col(name)
            for name in catalog.columns
        ],
        domain.alias("domain"),
    )


def unique_hits(instruments: DataFrame) -> DataFrame:
    """``(name, ins_code)`` of normalised names that exactly one instrument has."""
    named = instruments.select(
        text.normalize_letters(F.col("name")).alias("name"), F.col("ins_code")
    ).filter(F.col("name").isNotNull())
    hits = named.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.min("ins_code").alias("ins_code")
    )
    return hits.filter(F.col("n") == 1).select("name", "ins_code")


def add_ins_code(funds: DataFrame, instruments: DataFrame) -> DataFrame:
    """Fill missing instrument codes by a name search that must have exactly one hit.

    The search runs for names with a missing code; a found code goes to every fund of that
    name and wins over the old one.
    """
    searched = (
        funds.filter(F.col("ins_code").isNull())
        .select(text.normalize_letters(F.col("name")).alias("name"))
        .filter(F.col("name").isNotNull())
        .distinct()
    )
    hits = unique_hits(instruments).join(searched, "name", "left_semi")
    keyed = funds.withColumn("_name", text.normalize_letters(F.col("name")))
    found = hits.select(F.col("name").alias("_name"), F.col("ins_code").alias("_code"))
    joined = lookup_join(keyed, found, ["_name"])
    code = F.coalesce("_code", "ins_code").alias("ins_code")
    return joined.select(*[code if c == "ins_code" else F.col(c) for c in funds.columns])


def append_new(catalog: DataFrame, new: DataFrame) -> DataFrame:
    """Append new funds that have an instrument code; columns a side lacks are null."""
    coded = new.filter(F.col("ins_code").isNotNull()).drop("domain")
    wider = {"tinyint": "int", "smallint": "int"}
    types = dict(catalog.dtypes)
    for name, kind in catalog.dtypes:
        if kind in wider:
            catalog = catalog.withColumn(name, F.col(name).cast(wider[kind]))
            types[name] = wider[kind]
    shared = [F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in coded.columns]
    return catalog.unionByName(coded.select(*shared), allowMissingColumns=True)


def without_code(new: DataFrame) -> DataFrame:
    """New funds that stay out of the catalogue because no code was found."""
    return new.filter(F.col("ins_code").isNull())


def update_from_instruments(catalog: DataFrame, instruments: DataFrame) -> DataFrame:
    """Catalogue ⟕ instruments by ``ins_code``: instrument values win where not null.

    Shared columns are found before the join and merged in one projection; columns the
    catalogue does not have are ignored.
    """
    key = "ins_code"
    shared = [c for c in instruments.columns if c in catalog.columns and c != key]
    renamed = instruments.select(key, *[F.col(c).alias(f"_new_{c}") for c in shared])
    joined = lookup_join(catalog, one_per_key(renamed, [key]), [key])
    return joined.select(
        *[
            F.coalesce(f"_new_{c}", c).alias(c) if c in shared else F.col(c)
            for c in catalog.columns
        ]
    )


def instrument_feed(instruments: DataFrame) -> DataFrame:
    return instruments.drop("l30", "isin", "cisin")


def without_reg_no(catalog: DataFrame) -> DataFrame:
    """Site keys and symbols of the rows that still need a registration number."""
    return catalog.filter(F.col("reg_no").isNull()).select(
        "site_type", "url", "portfolio_id", "l18"
    )


def fill_reg_no(catalog: DataFrame, found: DataFrame) -> DataFrame:
    """Fill missing registration numbers from ``(l18, reg_no)``."""
    return with_value(catalog, found, ["l18"], "reg_no", new_wins=False)


def set_dps_interval(catalog: DataFrame, intervals: DataFrame) -> DataFrame:
    """Bring payout intervals by symbol; a missing one leaves the old value."""
    return with_value(catalog, intervals, ["l18"], "dps_interval", new_wins=True)


def correct_site_type(catalog: DataFrame, detected: DataFrame) -> DataFrame:
    """Replace stored vendor types by detected ones from ``(l18, site_type)``."""
    return with_value(catalog, detected, ["l18"], "site_type", new_wins=True)


def store_updates(values: DataFrame, keys: list[str], buckets: int) -> Lookup:
    """Store values that ``update_from_stored`` brings into a catalogue, one row per key."""
    renamed = [F.col(c).alias(f"_new_{c}") for c in values.columns if c not in keys]
    return store_lookup(values.select(*keys, *renamed), keys, buckets)


def update_from_stored(
    catalog: DataFrame, updates: list[Lookup], keys: list[str], filled: tuple[str, ...] = (), share: float = HOT_SHARE
) -> DataFrame:
    """Merge the columns of several stored updates into the catalogue, whose rows move once for all.

    New values win where not null; in the columns ``filled`` they only replace nulls. Columns the
    catalogue does not have are ignored. No two updates may hold the same column.
    """
    joined = lookup_values(catalog, updates, keys, share)
    merged = []
    for c in catalog.columns:
        new = f"_new_{c}"
        both = (c, new) if c in filled else (new, c)
        merged.append(F.coalesce(*both).cast(catalog.schema[c].dataType).alias(c) if new in joined.columns else F.col(c))
    return joined.select(*merged)


def store_sites(catalog: DataFrame, buckets: int) -> Lookup:
    """Store the site key of every symbol, for ``sites_of``."""
    return store_lookup(_sites(catalog), ["l18"], buckets)


def _sites(catalog: DataFrame) -> DataFrame:
    return catalog.select("l18", F.struct("site_type", "url", "portfolio_id").alias("site"))


def sites_of(
    symbols: DataFrame, catalog: DataFrame | Lookup, strict: bool = False, share: float = HOT_SHARE
) -> DataFrame:
    """Site key of every wanted symbol; an unknown one is an error when ``strict``.

    With the lookup of ``store_sites`` in place of the catalogue only the symbols are shuffled;
    ``share`` is that of a hot symbol there.
    """
    if isinstance(catalog, Lookup):
        found = lookup_values(symbols, [catalog], ["l18"], share)
    else:
        found = lookup_join(symbols, one_per_key(_sites(catalog), ["l18"]), ["l18"])
    if strict:
        message = F.concat(F.lit("not in the catalogue: "), F.coalesce("l18", F.lit("null")))
        site = F.coalesce("site", F.raise_error(message).cast(found.schema["site"].dataType))
        found = found.withColumn("site", site)
    return found.select(
        *symbols.columns, "site.site_type", "site.url", "site.portfolio_id", F.col("site").isNull().alias("missing")
    )
