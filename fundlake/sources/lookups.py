"""Lookup sides stored in buckets of their key, so that joins do not shuffle them again.

A catalogue or registry is read by many jobs and written by few. ``store_lookup`` reduces it to
one row per key and writes it hashed into buckets and sorted; a join on the key then moves the
left rows only, and further joins on that key with tables of as many buckets move nothing.

A key that holds a large share of the left rows would fill one bucket's task. The left keys are
therefore counted first (summed before they are shuffled), and the lookup rows of keys above the
share, of which there are at most ``1 / HOT_SHARE``, are broadcast instead. Both ways give the same rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators.lookup import one_per_key
from fundlake.session import discard, shared_folder, stored

#: A key with more than this share of the left rows is hot; there are at most 1 / share such keys.
HOT_SHARE = 1e-4
_HOT = "_hot_key"


@dataclass(frozen=True)
class Lookup:
    """A stored lookup: all that another session needs to open it again."""

    path: str
    keys: tuple[str, ...]
    buckets: int
    schema: str


def store_lookup(
    rows: DataFrame, keys: list[str], buckets: int, prefer: list[Column] | None = None, path: str | None = None
) -> Lookup:
    """Write one row per key (as ``one_per_key`` chooses it) into ``buckets`` sorted files, one a bucket.

    Rows with a null key go, since they match nothing. No rows give a lookup that matches nothing.
    Without a ``path`` the files go below the shared folder. A path is written once; a newer
    version of the table takes another one.
    """
    unique = one_per_key(rows, keys, prefer)
    path = path or shared_folder(rows.sparkSession, "lookup")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in unique.schema)
    lookup = Lookup(path, tuple(keys), buckets, schema)
    writer = unique.repartition(buckets, *keys).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(_table(lookup))
    return lookup


def _table(lookup: Lookup) -> str:
    return f"lookup_{hashlib.sha256(lookup.path.encode()).hexdigest()[:32]}"


def read_lookup(spark: SparkSession, lookup: Lookup) -> DataFrame:
    """The stored rows, known to the session as bucketed by their keys, whichever session wrote them."""
    keys = ", ".join(f"`{k}`" for k in lookup.keys)
    path = lookup.path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_table(lookup)} ({lookup.schema}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {lookup.buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(_table(lookup))


def remove_lookup(spark: SparkSession, lookup: Lookup) -> None:
    """Remove the files and the session's knowledge of them, once nothing reads them any more."""
    files = read_lookup(spark, lookup)
    files._stored_path = lookup.path
    discard(files)
    spark.sql(f"DROP TABLE {_table(lookup)}")


def hot_keys(left: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """The complete keys that more than ``share`` of the rows have, stored; at most ``1 / share``."""
    counts = stored(left.groupBy(*keys).agg(F.count("*").alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = stored(counts.where(F.col("n") > share * total).where(_complete(keys)).select(*keys), "hot-keys")
    discard(counts)
    return hot


def _complete(keys: list[str]) -> Column:
    held = F.lit(True)
    for k in keys:
        held = held & F.col(k).isNotNull()
    return held


def lookup_values(left: DataFrame, lookups: list[Lookup], keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """``left`` with the other columns of every lookup; what is not found, or has a null key, gets nulls.

    All lookups have the same ``keys`` and number of buckets, so the left rows are moved once for
    all of them, and no stored table is. No left row is lost or repeated, repeated left rows stay. Columns of
    ``left`` and of the lookups other than the keys must have different names.
    """
    if any((x.keys, x.buckets) != (tuple(keys), lookups[0].buckets) for x in lookups):
        raise ValueError("lookups of one join have the same keys and number of buckets")
    tables = [read_lookup(left.sparkSession, x) for x in lookups]
    hot = F.broadcast(hot_keys(left, keys, share))  # 1 / share keys at most
    marked = left.join(hot.withColumn(_HOT, F.lit(True)), keys, "left")
    in_buckets = F.col(_HOT).isNull() & _complete(keys)
    rare, others = marked.where(in_buckets).drop(_HOT), marked.where(~in_buckets).drop(_HOT)
    for table in tables:
        rare = rare.join(table.hint("merge"), keys, "left")
        others = others.join(F.broadcast(table.join(hot, keys, "left_semi")), keys, "left")
    names = [*left.columns, *[c for t in tables for c in t.columns if c not in keys]]
    return rare.select(*names).unionByName(others.select(*names))
