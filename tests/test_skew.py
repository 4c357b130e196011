"""Hot keys, nulls and copies: right results, and work that spreads over tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fundlake.operators import lookup, quality, reconcile
from fundlake.operators.quotes import latest_quotes


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def hot(spark):
    """24000 rows: a third on one key, a sixth on null, the rest on 400 keys."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("hot")).when(i % 6 != 1, (i % 400).cast("string"))
    return spark.range(0, 24000, 1, 8).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def names(spark):
    keys = [("hot", "H", 2), ("hot", "A", 1), (None, "N", 1)] + [
        (str(i), f"n{i}", i) for i in range(0, 400, 2)
    ]
    return spark.createDataFrame(keys, "k string, name string, rank int")


def expected_names(rows):
    found = {str(i): f"n{i}" for i in range(0, 400, 2)} | {"hot": "A"}
    return Counter((r["id"], r["k"], found.get(r["k"])) for r in rows)


def test_lookup_join_keeps_every_row(hot, names, no_broadcast):
    side = lookup.one_per_key(names, ["k"], [F.col("rank")]).drop("rank")
    joined = lookup.lookup_join(hot, side, ["k"])
    got = Counter((r["id"], r["k"], r["name"]) for r in joined.collect())
    assert got == expected_names(hot.collect())


def test_hot_key_spreads_over_tasks(hot, names, no_broadcast):
    side = lookup.one_per_key(names, ["k"])

    def tasks(salts):
        joined = lookup.lookup_join(hot, side, ["k"], salts=salts)
        placed = joined.select("k", "name", F.spark_partition_id().alias("p")).collect()
        return len({r["p"] for r in placed if r["k"] == "hot"})

    assert tasks(1) == 1
    assert tasks(8) >= 4


def test_anti_and_semi_joins(hot, names, no_broadcast):
    rows, known = hot.collect(), {r["k"] for r in names.collect()} - {None}
    keys = names.select(F.col("k").alias("other"))

    def ids(df):
        return sorted(r["id"] for r in df.collect())

    assert ids(lookup.unmatched(hot, keys, "k")) == [r["id"] for r in rows if r["k"] not in known]
    without_null = [r["id"] for r in rows if r["k"] not in known and r["k"] is not None]
    assert ids(lookup.unmatched(hot, keys, "k", keep_null=False)) == without_null
    assert ids(lookup.matched(hot, keys, "k")) == [r["id"] for r in rows if r["k"] in known]


def test_a_null_among_the_keys_empties_nothing(spark, hot):
    nothing = spark.createDataFrame([(None,)], "other string")
    assert lookup.unmatched(hot, nothing, "k").count() == hot.count()


def test_duplicate_rows_with_hot_and_null_keys(hot, no_broadcast):
    rows = hot.withColumn("v", (F.col("id") % 2).cast("string"))
    counts = Counter((r["k"], r["v"]) for r in rows.collect())
    wanted = sorted(r["id"] for r in rows.collect() if counts[r["k"], r["v"]] > 1)
    got = sorted(r["id"] for r in quality.duplicate_rows(rows, ["k", "v"]).collect())
    assert got == wanted


def test_duplicate_counts(hot):
    counted = {r["value"]: r["n"] for r in quality.duplicate_values(hot, ["k"]).collect()}
    wanted = {k: n for k, n in Counter(r["k"] for r in hot.collect()).items() if n > 1}
    assert counted == wanted


def test_identical_copies(spark, names, no_broadcast):
    copies = spark.range(0, 9000, 1, 8).select(F.lit("hot").alias("k"), F.lit(1).alias("x"))
    side = lookup.one_per_key(names, ["k"], [F.col("rank")])
    joined = lookup.lookup_join(copies, side, ["k"])
    assert joined.groupBy("name").count().collect() == [("A", 9000)]


def test_registry_update_keeps_the_number_of_rows(spark, hot):
    fields = "l18 string, type string, url string, site_type string, reg_no string, group_id byte"
    catalog = hot.select(
        F.col("id").cast("string").alias("l18"),
        F.lit("old").alias("type"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("site_type"),
        F.col("k").alias("reg_no"),
        F.lit(1).cast("byte").alias("group_id"),
    )
    assert fields.count(",") + 1 == len(catalog.columns)
    funds = spark.createDataFrame(
        [("hot", 1, "a.ir", "T", None, None), ("hot", 1, "b.ir", "T", "http://b/", "V"), ("hot", 2, "c", "X", None, None)],
        "reg_no string, group_id int, domain string, type string, url string, site_type string",
    )
    updated = reconcile.update_from_registry(catalog, funds)
    assert updated.count() == 24000
    changed = updated.filter("type = 'T'").groupBy("url", "site_type", "domain").count().collect()
    assert [tuple(r) for r in changed] == [("http://b/", "V", "b.ir", 8000)]


def test_portfolio_sets(spark):
    catalog = spark.createDataFrame(
        [("a", "1"), ("a", "2"), ("b", None), ("b", None), ("c", None), ("c", "5"), ("d", "1"), (None, "9")],
        "url string, portfolio_id string",
    )
    site = spark.createDataFrame(
        [("a", "2"), ("a", "1"), ("b", "1"), ("c", "5"), ("z", "1"), ("d", "7")],
        "url string, portfolio_id string",
    )
    got = sorted(quality.portfolio_mismatches(site, catalog).collect(), key=str)
    assert [tuple(r)[:2] + (r["on_site"],) for r in got] == sorted(
        [("c", None, False), ("d", "1", False), ("d", "7", True)], key=str
    )
    checked = spark.createDataFrame([("a",), ("e",)], "url string")
    none = site.filter("url = 'none'")
    only = quality.portfolio_mismatches(none, catalog, checked)
    assert sorted(r["portfolio_id"] for r in only.collect()) == ["1", "2"]


def test_latest_quote_of_a_hot_fund(spark):
    i = F.col("id")
    quotes = spark.range(0, 9000, 1, 8).select(
        F.lit("V").alias("site_type"),
        F.when(i % 3 == 0, "hot").otherwise((i % 50).cast("string")).alias("url"),
        F.lit("1").alias("portfolio_id"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"),
        F.timestamp_seconds(i * 7919 % 100000).cast("timestamp_ntz").alias("date"),
        i.cast("double").alias("creation"),
        i.cast("double").alias("redemption"),
    )
    best = {}
    for r in quotes.collect():
        if r["url"] not in best or (r["date"], r["creation"]) > best[r["url"]]:
            best[r["url"]] = (r["date"], r["creation"])
    got = {r["url"]: (r["date"], r["creation"]) for r in latest_quotes(quotes).collect()}
    assert got == best
