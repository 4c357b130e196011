"""What lenient reading could not keep: values of whole-number fields that are none.

Typed readers give null for such a value and say no more. Here the same bodies are read once
more as variants, all kinds of payload in one scan and without a shuffle, and every value that
a whole number cannot hold is a row with its text, its number if it is one, and the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from fundlake import constants as C
from fundlake import schemas as S
from fundlake.functions import text
from fundlake.functions.rows import exploded
from fundlake.operators.dividends import ENDPOINT as DIVIDENDS
from fundlake.operators.nav import CHART
from fundlake.operators.quotes import ENDPOINT as QUOTES
from fundlake.sources.payload import decode_json_string

#: A number with all digits that a payload may hold; beyond it, text is no number.
NUMBER = "decimal(38,10)"


def _whole_fields() -> dict[str, list[str]]:
    chart = StructType.fromDDL(S.MABNA_CHART)["data"].dataType.elementType
    return {
        CHART: [f.name for f in chart if isinstance(f.dataType, LongType)],
        DIVIDENDS: list(S.DIVIDEND_JSON_WHOLE),
        QUOTES: list(S.TADBIR_QUOTE_WHOLE),
    }


def _read() -> Column:
    """The responses whose payload declares whole numbers."""
    vendor, endpoint = F.col("site_type"), F.col("endpoint")
    return (
        ((endpoint == CHART) & (vendor == C.MABNA))
        | ((endpoint == DIVIDENDS) & vendor.isin(*C.RAYAN_FAMILY))
        | ((endpoint == QUOTES) & vendor.isin(C.TADBIR, C.TADBIR_MULTI))
    )


def _reason(value: Column, number: Column) -> Column:
    edge = F.lit(str(1 << 63)).cast(NUMBER)
    return (
        F.when(value.isNull(), None)
        .when(number.isNull(), "no number")
        .when(number != F.floor(number), "fraction")
        .when((number >= edge) | (number < -edge), "beyond 64 bits")
    )


def parse_violations(responses: DataFrame) -> DataFrame:
    """``(fund, endpoint, page, pos, field, text, number, reason)`` of every value that is cut.

    A body that is no JSON is one row without a field. Fields are known by the names of the
    typed readers, whose first letter a vendor may capitalise; missing and null fields are
    none of this. Digits may be Persian, and commas may part thousands.
    """
    rows = responses.filter(_read() & F.col("status").between(200, 299))
    keep = [*S.KEY, "endpoint", "page"]
    body = F.when(F.col("endpoint") == QUOTES, decode_json_string(F.col("body"))).otherwise(F.col("body"))
    parsed = rows.select(*keep, F.try_parse_json(body).alias("v"))
    listed = F.coalesce(
        F.try_variant_get("v", "$.data", "array<variant>"),
        F.try_variant_get("v", "$", "array<variant>"),
        F.array("v"),
    )
    records = exploded(parsed, keep, listed, "record")
    named = F.map_entries(F.try_variant_get("record", "$", "map<string, variant>"))
    fields = F.transform(
        named,
        lambda e: F.struct(
            F.concat(F.lower(F.substring(e["key"], 1, 1)), F.substring(e["key"], 2, 1 << 30)).alias("field"),
            F.try_variant_get(e["value"], "$", "string").alias("text"),
        ),
    )
    declared = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in _whole_fields().items() for x in pair])
    mine = F.filter(fields, lambda f: F.array_contains(declared[F.col("endpoint")], f["field"]))
    numbered = F.transform(
        mine,
        lambda f: F.struct(
            f["field"].alias("field"), f["text"].alias("text"), text.plain_number(f["text"], dropped=",").try_cast(NUMBER).alias("number")
        ),
    )
    broken = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("text"), F.lit(None).cast(NUMBER).alias("number"), F.lit("unreadable body").alias("reason")))
    told = F.transform(numbered, lambda f: F.struct(f["field"], f["text"], f["number"], _reason(f["text"], f["number"]).alias("reason")))
    found = F.when(F.col("record").isNull(), broken).otherwise(F.filter(told, lambda f: f["reason"].isNotNull()))
    flat = exploded(records, [*keep, "pos"], found, "_found", "_at")
    return flat.select(*keep, "pos", "_found.*")
