"""Lookups stored in buckets: plans without an exchange of the stored side, and the rows of a plain join."""

import re

import pytest
from pyspark.sql import functions as F

from fundlake.operators import reconcile
from fundlake.sources import lookups
from fundlake.sources.lookups import Lookup, hot_keys, lookup_values, read_lookup, remove_lookup, store_lookup


@pytest.fixture
def left(spark):
    """A third of the rows have one key, some have none, every row occurs twice."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 1, F.concat(F.lit("k"), F.col("id") % 500))
    rows = spark.range(6000).select(key.alias("k"), "id")
    return rows.union(rows)


@pytest.fixture
def side(spark):
    """Each key twice, the smaller value is the one that counts; some keys null or unasked for."""
    rows = [(f"k{i}", 2 * i + j) for i in range(100, 700) for j in (1, 0)]
    return spark.createDataFrame([*rows, ("hot", -1), (None, 5)], "k string, v long")


def expected(left, side):
    values = {}
    for k, v in side.collect():
        if k is not None:
            values[k] = min(v, values.get(k, v))
    return sorted(((k, i, values.get(k)) for k, i in left.collect()), key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("share", [lookups.HOT_SHARE, 0.01, 1.0])
def test_rows_are_those_of_a_plain_join(left, side, share):
    stored = store_lookup(side, ["k"], 8)
    assert rows(lookup_values(left, [stored], ["k"], share).select("k", "id", "v")) == expected(left, side)


def test_only_keys_above_the_share_are_hot(left):
    assert [tuple(r) for r in hot_keys(left, ["k"], 0.01).collect()] == [("hot",)]
    assert hot_keys(left.where("k is null"), ["k"]).count() == 0


def test_empty_sides(left, side):
    nothing = store_lookup(side.where("false"), ["k"], 4)
    got = lookup_values(left, [nothing], ["k"], 0.01)
    assert got.count() == left.count() and got.where("v is not null").count() == 0
    assert lookup_values(left.where("false"), [store_lookup(side, ["k"], 4)], ["k"]).collect() == []


def test_a_bucket_is_one_file(spark, side, tmp_path):
    store_lookup(side, ["k"], 8, path=str(tmp_path / "l"))
    names = [p.name for p in (tmp_path / "l").glob("*.parquet")]
    assert sorted(re.search(r"_(\d{5})\.", n).group(1) for n in names) == [f"{i:05d}" for i in range(8)]


def test_another_session_opens_it_and_it_goes(spark, side, tmp_path):
    stored = store_lookup(side, ["k"], 8, path=str(tmp_path / "it's"))
    spark.sql(f"DROP TABLE {lookups._table(stored)}")
    again = Lookup(stored.path, stored.keys, stored.buckets, stored.schema)
    assert read_lookup(spark, again).count() == 601
    remove_lookup(spark, again)
    assert not (tmp_path / "it's").exists()


def test_several_lookups_move_the_left_rows_once(spark, left, side):
    first = store_lookup(side, ["k"], 8)
    second = store_lookup(side.select("k", (F.col("v") + 1).alias("w")), ["k"], 8)
    got = lookup_values(left, [first, second], ["k"], 0.01)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # One exchange of rows in the bucket branch; the stored tables are scanned by bucket.
    assert len(re.findall(r"Exchange hashpartitioning\(k", plan)) == 1
    assert plan.count("SelectedBucketsCount: 8 out of 8") >= 2
    assert rows(got.select("k", "id", "v")) == expected(left, side)
    assert got.where("w <> v + 1").count() == 0


def test_lookups_of_other_keys_or_buckets_are_refused(left, side):
    with pytest.raises(ValueError):
        lookup_values(left, [store_lookup(side, ["k"], 8), store_lookup(side.toDF("k", "w"), ["k"], 4)], ["k"])


def test_several_keys(spark):
    left = spark.createDataFrame([("a", 1), ("a", None), (None, 1), ("b", 2)], "r string, g int")
    side = spark.createDataFrame([("a", 1, "x"), ("b", 3, "y"), (None, 1, "z")], "r string, g int, v string")
    stored = store_lookup(side, ["r", "g"], 4)
    for share in (1e-4, 1.0):
        got = rows(lookup_values(left, [stored], ["r", "g"], share).select("r", "g", "v"))
        assert got == sorted([("a", 1, "x"), ("a", None, None), (None, 1, None), ("b", 2, None)], key=repr)


def test_stored_updates_fill_or_win(spark):
    catalog = spark.createDataFrame([("a", "old", "t"), ("b", None, "t"), (None, None, "t")], "l18 string, reg_no string, site_type string")
    numbers = spark.createDataFrame([("a", "1"), ("b", "2")], "l18 string, reg_no string")
    types = spark.createDataFrame([("a", "new"), ("b", None)], "l18 string, site_type string")
    stored = [reconcile.store_updates(x, ["l18"], 4) for x in (numbers, types)]
    got = reconcile.update_from_stored(catalog, stored, ["l18"], filled=("reg_no",))
    assert rows(got) == sorted([("a", "old", "new"), ("b", "2", "t"), (None, None, "t")], key=repr)
