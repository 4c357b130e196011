"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group. Groups are dealt over tasks; each task places its groups,
largest first, into the open bin that they fill tightest, found in a balanced tree of remaining
capacities. Bins are a fixed small share of all bytes, so their number does not grow with the
data; they are packed in the same way into the smallest shard capacity that needs no extra shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import ROW, numbered
from fundlake.session import stored

#: Bins per shard: a bin is this share of a shard, so shards differ by about so little.
BINS_PER_SHARD = 512
#: Parts a group's rows are ranked in; a group larger than a shard is divided into them.
PARTS = 1024


class Capacities:
    """Remaining capacities in a balanced (AA) tree; the tightest fit is found in logarithmic time.

    Nodes are ``[key, left, right, level]`` with keys ``(remaining, bin)``.
    """

    def __init__(self):
        self.root = None

    def tightest(self, size: int):
        """Smallest key with at least ``size`` remaining, or None."""
        node, found = self.root, None
        while node:
            if node[0][0] >= size:
                found, node = node[0], node[1]
            else:
                node = node[2]
        return found

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _add(self, node, key):
        if not node:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._add(node[side], key)
        return _split(_skew(node))

    def _remove(self, node, key):
        if not node:
            return None
        if key < node[0]:
            node[1] = self._remove(node[1], key)
        elif key > node[0]:
            node[2] = self._remove(node[2], key)
        elif not node[1] and not node[2]:
            return None
        elif node[1]:
            low = node[1]
            while low[2]:
                low = low[2]
            node[0] = low[0]
            node[1] = self._remove(node[1], low[0])
        else:
            low = node[2]
            while low[1]:
                low = low[1]
            node[0] = low[0]
            node[2] = self._remove(node[2], low[0])
        least = min(_level(node[1]), _level(node[2])) + 1
        if least < node[3]:
            node[3] = least
            if node[2] and least < node[2][3]:
                node[2][3] = least
        node = _skew(node)
        if node[2]:
            node[2] = _skew(node[2])
            if node[2][2]:
                node[2][2] = _skew(node[2][2])
        node = _split(node)
        if node[2]:
            node[2] = _split(node[2])
        return node


def _level(node) -> int:
    return node[3] if node else 0


def _skew(node):
    left = node[1]
    if left and left[3] == node[3]:
        node[1], left[2] = left[2], node
        return left
    return node


def _split(node):
    right = node[2]
    if right and right[2] and node[3] == right[2][3]:
        node[2], right[1] = right[1], node
        right[3] += 1
        return right
    return node


def best_fit(sizes, capacity: int) -> tuple[list[int], int]:
    """Bin of each size, and how many bins; ``sizes`` descend. A larger size gets a bin of its own."""
    tree, bins, places = Capacities(), 0, []
    for size in sizes:
        key = tree.tightest(size)
        if key is None:
            key = (max(capacity, size), bins)
            bins += 1
        else:
            tree.remove(key)
        places.append(key[1])
        tree.add((key[0] - size, key[1]))
    return places, bins


def smallest_capacity(sizes: list[int], shards: int) -> tuple[list[int], int]:
    """Best-fit decreasing with the smallest capacity, by bisection, that fills at most ``shards`` bins."""
    low, high = max(-(-sum(sizes) // shards), max(sizes, default=1)), max(1, sum(sizes))
    places, used = best_fit(sizes, high)
    while low < high:
        middle = (low + high) // 2
        tried, bins = best_fit(sizes, middle)
        if bins <= shards:
            places, high = tried, middle
        else:
            low = middle + 1
    return places, high


def _bins(capacity: int):
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, cell, bins, rows = Capacities(), None, 0, {}
        for batch in batches:
            places, starts = [], []
            for at, size, n in zip(batch["cell"].tolist(), batch["size"].tolist(), batch["n"].tolist()):
                if at != cell:
                    tree, cell, bins, rows = Capacities(), at, 0, {}
                key = tree.tightest(size)
                if key is None:
                    key = (max(capacity, size), bins)
                    bins += 1
                else:
                    tree.remove(key)
                left = key[0] - size
                if left > 0:
                    tree.add((left, key[1]))
                start = rows.get(key[1], 0)
                rows[key[1]] = start + n
                places.append((at << 32) + key[1])
                starts.append(start)
            yield batch[["g", "unit"]].assign(bin=places, first=starts, size=batch["size"], n=batch["n"])

    return fill


def _shards(shards: int):
    def place(bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values(["size", "bin"], ascending=[False, True], kind="stable")
        places, _ = smallest_capacity(bins["size"].tolist(), shards)
        bins = bins.assign(shard=places)
        bins["base"] = bins.groupby("shard")["n"].cumsum() - bins["n"]
        return bins[["bin", "shard", "base"]].astype({"shard": "int32"})

    return place


def sharded(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row, doc_id, size, text_crc32, shard, slot`` of every row; shards hold nearly equal bytes.

    A row's size is its text's UTF-8 bytes plus 1; null texts count as empty. Rows of equal text
    share a shard, unless together they exceed an even share of all bytes: such a group is dealt
    in parts. Slots count a shard's rows from 0. Repeated and null ids are rows like any other.
    """
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = numbered(docs).select(
        ROW,
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.xxhash64(data).alias("g"),
        F.pmod(F.xxhash64(F.col(ROW), F.lit(7)), F.lit(PARTS)).cast("int").alias("part"),
    )
    rows = stored(rows, "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1, -(-total // shards))
    parts = rows.groupBy("g", "part").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    by_group = Window.partitionBy("g")
    whole = F.sum("size").over(by_group) <= share
    parts = parts.withColumn("unit", F.when(whole, -1).otherwise(F.col("part"))).withColumn(
        "before",
        F.coalesce(F.sum("n").over(Window.partitionBy("g", "unit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    parts = stored(parts, "parts")
    units = parts.groupBy("g", "unit").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    cells = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.withColumn("cell", F.pmod(F.xxhash64("g", "unit", F.lit(3)), F.lit(cells)))
    capacity = max(1, share // BINS_PER_SHARD)
    ordered = units.repartition(cells, "cell").sortWithinPartitions("cell", F.desc("size"), "g", "unit")
    filled = stored(
        ordered.mapInPandas(_bins(capacity), "g long, unit int, bin long, first long, size long, n long"), "bins"
    )
    bins = filled.groupBy("bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    # At most twice shards * BINS_PER_SHARD bins and one more per cell, whatever the data.
    placed = bins.groupBy(F.lit("all")).applyInPandas(_shards(shards), "bin long, shard int, base long")
    where = (
        parts.select("g", "unit", "part", "before")
        .join(filled.select("g", "unit", "bin", "first"), ["g", "unit"])
        .join(placed, "bin")
        .select("g", "part", "shard", (F.col("base") + F.col("first") + F.col("before")).alias("start"))
    )
    rank = F.row_number().over(Window.partitionBy("g", "part").orderBy(F.asc_nulls_last("doc_id"), ROW)) - 1
    return rows.withColumn("rank", rank).join(where, ["g", "part"]).select(
        ROW, "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank")).alias("slot")
    )
