"""Positions and running totals in a global order, without putting all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.session import stored

#: Bits of a running number that count the rows of one range; the range's number is above them.
_BITS = 33


def positioned(rows: DataFrame, order: list[Column], name: str = "position", weight: str | None = None) -> DataFrame:
    """``rows`` with ``name``: how many rows, or how much ``weight`` (whole, not null), stand before each.

    Rows are dealt into ranges of ``order``, sorted inside each, and stored with their number in
    the range. One count a range then gives the offsets, as many as there are shuffle
    partitions. ``order`` must tell rows apart, both for one result and because equal keys share
    a range. No rows give none. ``name`` must not be a column of ``rows``.
    """
    at, part, offset = (f"{name}_{x}" for x in ("at", "part", "offset"))
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    table = stored(ranges, "positions", compression="zstd").withColumn(part, F.shiftright(at, _BITS))
    if weight is None:
        before, size = F.col(at) - F.shiftleft(part, _BITS), F.count("*")
    else:
        earlier = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before, size = F.sum(weight).over(earlier) - F.col(weight), F.sum(weight)
    total, offsets = 0, []
    for r in sorted(table.groupBy(part).agg(size.alias("size")).collect()):
        offsets.append((r[part], total))
        total += r["size"]
    ranges = rows.sparkSession.createDataFrame(offsets, f"{part} long, {offset} long")
    found = table.withColumn(name, before).join(F.broadcast(ranges), part)
    return found.withColumn(name, F.col(name) + F.col(offset)).drop(at, part, offset)
