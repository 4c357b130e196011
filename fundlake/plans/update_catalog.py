"""Catalogue update, end to end."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from fundlake.operators import reconcile as R
from fundlake.sources.tables import sink_catalog, sink_unresolved


class CatalogUpdate(NamedTuple):
    catalog: DataFrame
    unresolved: DataFrame
    missing_from_registry: DataFrame


def update_catalog(
    catalog: DataFrame,
    registry: DataFrame,
    instruments: DataFrame,
    probes: DataFrame,
    update_existing: bool = False,
) -> CatalogUpdate:
    """Reconcile the catalogue with the registry, probed sites and exchange instruments.

    One lazy plan with three results: the new catalogue, the new funds without an
    instrument code, and the catalogue rows that the registry does not know. ``probes``
    holds ``(domain, url, site_type)``. With ``update_existing`` known domains are probed
    again, yet a stored URL still wins over a probed one.
    """
    funds = R.registry_funds(registry)
    with_site = R.add_site(funds, probes, catalog, update_existing)
    existing = R.update_from_registry(catalog, with_site)
    new = R.add_ins_code(R.new_funds(funds, catalog), instruments)
    grown = R.append_new(existing.drop("domain"), new)
    updated = R.update_from_instruments(grown, R.instrument_feed(instruments))
    return CatalogUpdate(
        updated, R.without_code(new), R.missing_from_registry(catalog, registry)
    )


def write_update(update: CatalogUpdate, catalog_path: str, unresolved_path: str) -> None:
    """Store the new catalogue version and the report of funds that could not be added.

    Both paths must be new: a job cannot overwrite the catalogue it reads.
    """
    sink_catalog(update.catalog, catalog_path)
    sink_unresolved(update.unresolved, unresolved_path)
