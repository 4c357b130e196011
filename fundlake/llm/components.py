"""Connected components of a table of links, as joins; nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.session import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node of links ``x``, ``y``.

    A round points every node to its least neighbour, where that is smaller, and follows the pointers
    to their ends. Then links lead from end to end, and those within one end go, so each round reads
    only links between nodes not joined yet, of which there are at most half as many. Rounds, and
    the steps to an end, grow with the logarithm of the nodes.
    """
    edges = stored(_links(links), "edges")
    labels = None
    while True:
        ends = _ends(edges)
        left = ends.select(F.col("node").alias("x"), F.col("label").alias("from"))
        right = ends.select(F.col("node").alias("y"), F.col("label").alias("to"))
        rest = edges.join(left, "x").join(right, "y").select(F.col("from").alias("x"), F.col("to").alias("y"))
        rest = stored(_links(rest), "edges")
        discard(edges)
        edges = rest
        if labels is None:
            labels = ends
        else:
            further = ends.select(F.col("node").alias("label"), F.col("label").alias("end"))
            joined = labels.join(further, "label", "left").select("node", F.coalesce("end", "label").alias("label"))
            before, labels = labels, stored(joined, "labels")
            discard(before, ends)
        if edges.isEmpty():
            discard(edges)
            return labels


def _links(links: DataFrame) -> DataFrame:
    return links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct()


def _ends(edges: DataFrame) -> DataFrame:
    """Stored ``node`` and ``label``, where pointers to least neighbours end; a step doubles the way that a pointer goes."""
    both = edges.union(edges.select("y", "x"))
    labels = both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("label"))
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = stored(labels.join(jump, "label").select("node", F.col("label").alias("old"), F.col("further").alias("label")), "labels")
        discard(labels)
        labels = step.select("node", "label")
        labels._stored_path = step._stored_path
        if step.where("old <> label").isEmpty():
            return labels
