"""Positions and running totals in a global order."""

import random

from pyspark.sql import functions as F

from fundlake.operators.positions import positioned
from fundlake.schemas import CATALOG
from fundlake.sources.tables import catalog_positions
from tests.test_plans import plan


def test_positions_with_ties_nulls_and_many_equal_keys(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", None, "b", "c"]), i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "k string, n long").repartition(7)
    found = positioned(docs, [F.asc_nulls_first("k"), F.col("n")], "at")
    wanted = {r: i for i, r in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])))}
    assert {(r["k"], r["n"]): r["at"] for r in found.collect()} == wanted
    assert "SinglePartition" not in plan(found) and found.columns == ["k", "n", "at"]


def test_running_totals(spark):
    rows = [(i, (i * 7) % 5) for i in range(500)]
    found = positioned(spark.createDataFrame(rows, "n long, w long").repartition(5), [F.col("n")], "before", weight="w")
    total, wanted = 0, {}
    for n, w in rows:
        wanted[n] = total
        total += w
    assert {r["n"]: r["before"] for r in found.collect()} == wanted


def test_no_rows(spark):
    assert positioned(spark.createDataFrame([], "n long, w long"), [F.col("n")]).count() == 0
    assert positioned(spark.createDataFrame([], "n long, w long"), [F.col("n")], weight="w").count() == 0


def test_catalog_positions_give_equal_rows_neighbouring_places(spark):
    kinds = [f.split() for f in CATALOG.split(", ")]
    rows = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "l18 string")
    rows = rows.select(*[(F.col(n) if n == "l18" else F.lit(None)).cast(k).alias(n) for n, k in kinds])
    found = catalog_positions(rows).select("position", "l18").collect()
    assert sorted(map(tuple, found)) == [(0, None), (1, "a"), (2, "a"), (3, "b")]
