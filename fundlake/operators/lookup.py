"""Joins against a side that holds each key once, safe for hot keys.

A lookup side is first reduced to one row per key. Spark broadcasts it when its measured
size allows; otherwise both sides are shuffled, and then a key that holds a large share of
the left rows (null included) would end in one task. So the left rows are spread over
``salts`` groups by the partition they were read from, and each lookup row is copied into
every group. There are as many groups as the square root of the shuffle partitions, so that they grow with
the cluster; adaptive execution splits what is still too large. The salt depends on the partition alone, so a task that runs again after a
lost executor computes the same one.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def default_salts(rows: DataFrame) -> int:
    """Groups that a hot key is spread over unless the caller says how many; two at least."""
    return max(2, isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def one_per_key(rows: DataFrame, keys: list[str], prefer: list[Column] | None = None) -> DataFrame:
    """One row per key, chosen by the smallest ``prefer`` values, then by the row itself.

    Rows with a null key can never match and are dropped. The choice is a minimum, so
    repeats shrink before they are shuffled.
    """
    others = [name for name in rows.columns if name not in keys]
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    if not others:
        return rows.select(*keys).distinct()
    order = [p.alias(f"_p{i}") for i, p in enumerate(prefer or [])]
    nulls_last = [F.col(name).isNull().alias(f"_n{i}") for i, name in enumerate(others)]
    best = F.min(F.struct(*order, *nulls_last, *others)).alias("_best")
    picked = rows.groupBy(*keys).agg(best)
    return picked.select(*keys, *[F.col(f"_best.{name}").alias(name) for name in others])


def _salted(left: DataFrame, right: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    spread = left.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(salts)))
    copies = F.sequence(F.lit(0), F.lit(salts - 1))
    return spread, right.withColumn(_SALT, F.explode(copies))


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", salts: int | None = None
) -> DataFrame:
    """Join with a side that is unique by ``on``; the number of left rows never grows."""
    salts = default_salts(left) if salts is None else salts
    if salts <= 1:
        return left.join(right, on, how)
    spread, copied = _salted(left, right, salts)
    return spread.join(copied, [*on, _SALT], how).drop(_SALT)


def _on_one_name(left: DataFrame, keys: DataFrame, left_on: str) -> DataFrame:
    (name,) = keys.columns
    return keys.select(F.col(f"`{name}`").alias(left_on)).filter(F.col(f"`{left_on}`").isNotNull()).distinct()


def unmatched(
    left: DataFrame, keys: DataFrame, left_on: str, keep_null: bool = True, salts: int | None = None
) -> DataFrame:
    """Left rows whose key is not among ``keys`` (a one-column table).

    A null key matches nothing. ``keep_null`` says whether such rows stay, as in an anti
    join, or go, as with a negated membership test.
    """
    if not keep_null:
        left = left.filter(F.col(f"`{left_on}`").isNotNull())
    return lookup_join(left, _on_one_name(left, keys, left_on), [left_on], "left_anti", salts)


def matched(left: DataFrame, keys: DataFrame, left_on: str, salts: int | None = None) -> DataFrame:
    """Left rows whose key is among ``keys`` (a one-column table)."""
    return lookup_join(left, _on_one_name(left, keys, left_on), [left_on], "left_semi", salts)


def with_value(
    left: DataFrame,
    values: DataFrame,
    on: list[str],
    column: str,
    new_wins: bool,
    salts: int | None = None,
) -> DataFrame:
    """Merge ``column`` from a lookup table into the column of the same name.

    ``new_wins`` says which side is preferred; the other one fills its nulls.
    """
    new = "_new_value"
    lookup = one_per_key(values.select(*on, F.col(column).alias(new)), on)
    joined = lookup_join(left, lookup, on, salts=salts)
    pair = [F.col(new), F.col(column)] if new_wins else [F.col(column), F.col(new)]
    merged = F.coalesce(*pair).alias(column)
    return joined.select(*[merged if name == column else F.col(f"`{name}`") for name in left.columns])
