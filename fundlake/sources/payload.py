"""Readers for response bodies: JSON in several wrappings, HTML tables, script state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake import constants as C
from fundlake.functions import text
from fundlake.functions.rows import exploded, keep_where

_CELL = "<td>([^<]*)</td>"
_ROW_BREAK = r"(?U)</tr>\s*<tr>"


def from_json(body: Column, schema: str, strict: bool = False) -> Column:
    """JSON text -> declared schema; malformed text is null, or an error when ``strict``."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return F.from_json(body, schema, {"mode": mode})


def decode_json_string(body: Column) -> Column:
    """A body that is a JSON *string* -> the text inside it."""
    return F.get_json_object(F.concat(F.lit("["), body, F.lit("]")), "$[0]")


def read_records(responses: DataFrame, schema: str, keep: list[str]) -> DataFrame:
    """A body holding a list of records -> one row per record, in payload order."""
    records = exploded(responses, keep, from_json(F.col("body"), schema), "_record")
    return records.select(*keep, "pos", "_record.*")


def report_cells(pages: DataFrame, keep: list[str], until_last: bool) -> DataFrame:
    """HTML report pages -> one row of cells per table row; rows without cells vanish.

    The table body ends at the first ``</tbody>``, or at the last one when ``until_last``.
    A page is cut into rows inside its own task, so nothing is shuffled, and the body is
    dropped at once. ``(page, pos)`` keeps the order of the report.
    """
    rest = text.after_first(F.col("body"), "<tbody>")
    table = text.before_last(rest, "</tbody>") if until_last else text.before_first(rest, "</tbody>")
    rows = exploded(pages, keep, F.split(table, _ROW_BREAK), "_row")
    cells = F.regexp_extract_all("_row", F.lit(_CELL), F.lit(1)).alias("cells")
    return keep_where(rows.select(*keep, "pos", cells), F.size("cells") > 0)


def script_state(html: Column, marker: str, end: str = ";\n") -> Column:
    """State blob of a page script -> its JSON text; null without the marker."""
    blob = text.before_first(text.after_last(html, marker), end)
    return decode_json_string(blob)


def page_state(html: Column) -> Column:
    """The three state blobs of a home page as JSON text."""
    return F.struct(
        script_state(html, C.QUERY_STATE).alias("query_state"),
        script_state(html, C.REDUX_STATE).alias("redux_state"),
        script_state(html, C.ENV_STATE, "\n").alias("env"),
    )


def layout_model(html: Column) -> Column:
    """Record assigned to the layout variable of a portal page, as JSON text."""
    return F.when(
        html.contains(C.LAYOUT_MODEL),
        text.before_first(text.after_first(html, C.LAYOUT_MODEL), ";"),
    )
