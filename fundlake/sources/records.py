"""Records of feeds that are passed through as they come, undeclared fields included.

A body becomes one ``variant`` a record: numbers keep all their digits, nested values stay
whole, and a field that a vendor adds tomorrow is there without a change of schema. Typed
columns are read from the variant by path; ``fields`` lists every field as a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.rows import exploded

RECORD = "record"


def open_records(rows: DataFrame, keep: list[str], body: Column, path: str = "$") -> DataFrame:
    """One row per record of the list at ``path``: ``(keep…, pos, record)``.

    A body that is no JSON, or has no list there, gives no row. Nothing is shuffled.
    """
    listed = F.try_variant_get(F.try_parse_json(body), path, "array<variant>")
    return exploded(rows, keep, listed, RECORD)


def field(name: str, kind: str) -> Column:
    """A field of the record, null where it is missing or of another kind; other spellings are other fields."""
    quote = "'" if '"' in name else '"'
    return F.try_variant_get(F.col(RECORD), f"$[{quote}{name}{quote}]", kind)


def fields(records: DataFrame, keep: list[str]) -> DataFrame:
    """Every field of every record: ``(keep…, field, value, kind)``, values as text, nested ones as JSON, null as null.

    The record is taken apart in its own row. Records that are no objects have no fields.
    """
    pairs = F.transform(
        F.map_entries(F.try_variant_get(F.col(RECORD), "$", "map<string, variant>")),
        lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value")),
    )
    flat = exploded(records, keep, pairs, "_field", "_at")
    value = F.col("_field.value")
    kind = F.schema_of_variant(value)
    text = F.when(~F.is_variant_null(value), F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))
    return flat.select(*keep, F.col("_field.field").alias("field"), text.alias("value"), kind.alias("kind"))
