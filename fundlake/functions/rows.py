"""Row generation and row filters that leave expensive parsing where it is.

Spark moves a plain filter below the projection that computes its columns, and it guards an
inner explode with a filter on the exploded array. Both repeat the parsing inside the
filter. The helpers here use outer generators, whose output filters stay where they are, so
every payload is parsed once. The array is computed in a projection ahead of the generator,
where repeated parts of an expression are shared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(
    rows: DataFrame, keep: list, array: Column, value: str = "value", pos: str = "pos"
) -> DataFrame:
    """One row per array element with its position; empty and null arrays give none."""
    staged = rows.select(*keep, array.alias("_array"))
    names = staged.columns[:-1]
    flat = staged.select(*names, F.posexplode_outer("_array").alias(pos, value))
    return flat.filter(F.col(pos).isNotNull())


def inlined(rows: DataFrame, keep: list[str], array: Column) -> DataFrame:
    """One row per struct of the array, its fields as columns."""
    return exploded(rows, keep, array, "_r", "_p").select(*keep, "_r.*")


def keep_where(rows: DataFrame, condition: Column) -> DataFrame:
    """Filter on parsed columns without parsing them a second time."""
    flag = F.explode_outer(F.when(condition, F.array(F.lit(True)))).alias("_keep")
    return rows.select("*", flag).filter(F.col("_keep").isNotNull()).drop("_keep")
