"""Catalogue storage, whole-job runs, lookups that must fail, and the quote streams."""

import datetime
import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundlake.functions.text import WHITESPACE
from fundlake.operators import quality, quotes, reconcile
from fundlake.plans.check_catalog import CatalogError, check_static, require_clean
from fundlake.plans.update_catalog import update_catalog, write_update
from fundlake.schemas import CATALOG, REGISTRY, RESPONSES
from fundlake.sources.tables import (
    resort_catalog_csv,
    scan_catalog,
    scan_catalog_csv,
    scan_feed,
    scan_registry,
    sink_catalog_csv,
    with_site,
)
from fundlake.streaming.quote_stream import (
    keep_latest,
    quote_stream,
    read_latest,
    read_quotes,
    read_landing_stream,
    write_quotes,
)


def fund(l18, **values):
    names = [f.split()[0] for f in CATALOG.split(", ")]
    return tuple({"l18": l18, **values}.get(n) for n in names)


def test_csv_text_is_read_as_written(spark, tmp_path):
    header = ",".join(f.split()[0] for f in CATALOG.split(", "))
    lines = [
        header,
        'ب,"نام, ""دو""",Stock,1,2,http://a/,,TadbirPardaz,3,1',
        'الف,"",Fixed,,,,,,,',
        'ج,"two\nlines",,,,,,,,-1',
    ]
    file = tmp_path / "dataset.csv"
    file.write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    rows = {r["l18"]: r for r in scan_catalog_csv(spark, str(file)).collect()}
    assert rows["ب"]["name"] == 'نام, "دو"' and rows["ب"]["dps_interval"] == 3
    assert rows["ب"]["portfolio_id"] is None
    assert rows["الف"]["name"] == "" and rows["الف"]["ins_code"] is None
    assert rows["ج"]["name"] == "two\nlines" and rows["ج"]["group_id"] == -1
    site = with_site(scan_catalog_csv(spark, str(file))).filter("l18 = 'ب'").first()["site"]
    assert tuple(site) == ("TadbirPardaz", "http://a/", "")


def test_csv_is_sorted_normalised_and_marked(spark, tmp_path):
    rows = spark.createDataFrame(
        [fund("يك", name="كي"), fund(None, name="n"), fund("a", name=" b "), fund("ی", name="")], CATALOG
    )
    path = str(tmp_path / "one")
    sink_catalog_csv(rows, path)
    parts = sorted(glob.glob(f"{path}/*.csv"))
    for part in parts:
        assert open(part, "rb").read().startswith(b"\xef\xbb\xbfl18,")
    text = "".join(open(p, encoding="utf-8-sig").read().split("\n", 1)[1] for p in parts)
    assert [line.split(",")[0] for line in text.split("\n")[:-1]] == ["", "a", "ی", "یک"]
    again = str(tmp_path / "two")
    resort_catalog_csv(spark, path, again)
    stored = {tuple(r) for r in scan_catalog_csv(spark, again).collect()}
    assert ("a", " b ") in {r[:2] for r in stored} and ("یک", "کی") in {r[:2] for r in stored}


def test_update_job(spark, tmp_path):
    catalog = spark.createDataFrame(
        [
            fund("A", name="a", type="Old", ins_code="1", reg_no="10", group_id=1),
            fund("B", name="b", type="Old", ins_code="2", reg_no="20", group_id=1, url="http://known.ir/", site_type="X"),
            fund("C", name="c", type="Old", ins_code="3", reg_no=None, group_id=1),
        ],
        CATALOG,
    )
    feed = [
        ("10", None, 1, "Negotiable", 6, True, "A", "a", "new.ir", 0),
        ("20", None, 1, "Negotiable", 4, True, "B", "b", "known.ir", 0),
        ("30", None, 1, "Negotiable", 99, True, "D", "found", "new.ir", 0),
        ("40", None, 1, "Negotiable", 5, True, "E", "lost", None, 0),
        ("50", "9", 1, "Private", 5, True, "F", "f", None, 0),
        ("60", "9", 1, "Negotiable", 11, True, "G", "g", None, 0),
        ("70", "9", 1, "Negotiable", 5, False, "H", "h", None, 0),
        (None, "9", 1, "Negotiable", 5, True, "I", "i", None, 0),
    ]
    spark.createDataFrame(feed, REGISTRY).write.parquet(str(tmp_path / "registry"))
    registry = scan_registry(spark, str(tmp_path / "registry"))
    instruments = spark.createDataFrame(
        [("1", "A2", None, "x"), ("7", "D2", "found", "x"), ("8", "L1", "lost", "x"), ("9", "L2", "lost", "x")],
        "ins_code string, l18 string, name string, isin string",
    )
    instruments.write.parquet(str(tmp_path / "instruments"))
    instruments = scan_feed(spark, str(tmp_path / "instruments"))
    probes = spark.createDataFrame(
        [("new.ir", "http://www.new.ir/", "MabnaDP2"), ("known.ir", "http://other.ir/", "Y")],
        "domain string, url string, site_type string",
    )
    update = update_catalog(catalog, registry, instruments, probes)
    write_update(update, str(tmp_path / "v1"), str(tmp_path / "unresolved"))
    rows = {r["name"]: r for r in scan_catalog(spark, str(tmp_path / "v1")).collect()}
    assert set(rows) == {"a", "b", "c", "found"}
    assert (rows["a"]["l18"], rows["a"]["type"], rows["a"]["url"]) == ("A2", "Stock", "http://www.new.ir/")
    assert rows["a"]["site_type"] == "MabnaDP2"
    assert (rows["b"]["type"], rows["b"]["url"], rows["b"]["site_type"]) == ("Fixed", "http://known.ir/", "X")
    assert (rows["c"]["type"], rows["c"]["url"]) == ("Old", None)
    assert (rows["found"]["l18"], rows["found"]["type"], rows["found"]["ins_code"]) == ("D2", "99", "7")
    unresolved = spark.read.parquet(str(tmp_path / "unresolved")).collect()
    assert [r["name"] for r in unresolved] == ["lost"]
    assert update.missing_from_registry.count() == 0

    again = update_catalog(catalog, registry, instruments, probes, update_existing=True)
    url = again.catalog.filter("name = 'b'").first()["url"]
    assert url == "http://known.ir/"


def test_strict_check_fails_after_the_violations_are_stored(spark, tmp_path):
    labels = {"type": "Stock", "site_type": "X"}
    clean = spark.createDataFrame(
        [fund("A", name="a", ins_code="1", reg_no="1", url="u/", **labels), fund("B", name="b", ins_code="2", reg_no="2", url="v/", **labels)],
        CATALOG,
    )
    require_clean(check_static(clean))
    flawed = clean.withColumn("l18", F.lit("same"))
    check_static(flawed).write.parquet(str(tmp_path / "violations"))
    stored = spark.read.parquet(str(tmp_path / "violations"))
    assert [tuple(r) for r in stored.collect()] == [("repeated l18", "same", "2")]
    with pytest.raises(CatalogError):
        require_clean(stored)


def test_nulls_in_uniqueness_rules(spark):
    rows = spark.createDataFrame([(None, "u", "1"), (None, "u", "1"), ("x", None, "2"), ("y", "u", "2")], "name string, url string, reg_no string")
    assert [tuple(r) for r in quality.duplicate_values(rows, ["name"]).collect()] == [("name", None, 2)]
    counts = {r["reg_no"]: r["cnt"] for r in quality.values_per_key(rows, "reg_no", "url").collect()}
    assert counts == {"1": 1, "2": 2}


def test_unknown_symbol(spark):
    catalog = spark.createDataFrame([fund("A", url="http://a/", site_type="T")], CATALOG)
    wanted = spark.createDataFrame([("A",), ("B",)], "l18 string")
    found = {r["l18"]: (r["url"], r["missing"]) for r in reconcile.sites_of(wanted, catalog).collect()}
    assert found == {"A": ("http://a/", False), "B": (None, True)}
    assert reconcile.sites_of(wanted.filter("l18 = 'A'"), catalog, strict=True).count() == 1
    with pytest.raises(PySparkException, match="not in the catalogue: B"):
        reconcile.sites_of(wanted, catalog, strict=True).collect()


def test_new_funds_keep_their_own_values(spark):
    catalog = spark.createDataFrame([fund("A", group_id=1)], CATALOG)
    new = spark.createDataFrame([("B", 300, "9", "d.ir")], "l18 string, group_id int, ins_code string, domain string")
    grown = reconcile.append_new(catalog, new)
    assert dict(grown.dtypes)["group_id"] == "int"
    assert grown.filter("l18 = 'B'").first()["group_id"] == 300


def test_whitespace_list():
    assert len(set(WHITESPACE)) == 25 and all(c.isspace() for c in WHITESPACE)


def quote_body(second, price):
    at = f"2024-01-01T10:00:{second:02d}+03:30"
    return f'{{"data":{{"redemption_price":{price},"purchase_price":{price + 1},"date_time":"{at}"}}}}'


def captures(spark, rows):
    at = datetime.datetime(2024, 1, 1)
    full = [
        ("MabnaDP2", url, "1", "live_navps", 1, 200, at + datetime.timedelta(seconds=i), quote_body(s, p))
        for i, (url, s, p) in enumerate(rows)
    ]
    return spark.createDataFrame(full, RESPONSES)


def test_stream_keeps_quotes_far_behind_a_future_one(spark, tmp_path):
    """One batch per file: a quote dated 2030, then a backfill of old quotes captured earlier."""
    landing, at = str(tmp_path / "landing"), datetime.datetime(2024, 3, 1)
    body = '{"data":{"redemption_price":1,"purchase_price":2,"date_time":"%s-01-01T10:00:00+03:30"}}'
    for i, year in enumerate([2030, 2024, 2023, 2022, 2024]):
        row = ("MabnaDP2", "http://a/", "1", "live_navps", 1, 200, at - datetime.timedelta(days=9 * i), body % year)
        spark.createDataFrame([row], RESPONSES).coalesce(1).write.mode("append").parquet(landing)
    stream = quote_stream(read_landing_stream(spark, landing, files_per_trigger=1))
    write_quotes(stream, str(tmp_path / "quotes"), str(tmp_path / "state")).awaitTermination()
    rows = read_quotes(spark, str(tmp_path / "quotes")).collect()
    assert sorted(r["date"].year for r in rows) == [2022, 2023, 2024, 2030]


def test_streams(spark, tmp_path):
    landing = str(tmp_path / "landing")
    repeated = [("http://hot/", 5, 100)] * 40
    captures(spark, [*repeated, ("http://hot/", 3, 90), ("http://b/", 1, 7)]).coalesce(1).write.mode("append").parquet(landing)
    bad = captures(spark, [("http://bad/", 1, 1)]).withColumn("body", F.lit("{"))
    bad.write.mode("append").parquet(landing)

    def run(start, name):
        stream = quote_stream(read_landing_stream(spark, landing, files_per_trigger=1))
        start(stream, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()

    run(write_quotes, "quotes")
    run(keep_latest, "latest")
    captures(spark, [("http://hot/", 5, 100), ("http://b/", 9, 8)]).coalesce(1).write.mode("append").parquet(landing)
    run(write_quotes, "quotes")
    run(keep_latest, "latest")

    stored = spark.read.parquet(str(tmp_path / "quotes")).select("url", "redemption").collect()
    assert sorted(map(tuple, stored)) == [("http://b/", 7.0), ("http://b/", 8.0), ("http://hot/", 90.0), ("http://hot/", 100.0)]
    newest = read_latest(spark, str(tmp_path / "latest")).collect()
    assert {r["url"]: r["redemption"] for r in newest} == {"http://hot/": 100.0, "http://b/": 8.0}


def drained(spark, tmp_path, *batches):
    """Land each batch as a file of its own, and run both tables until used up after each."""
    landing = str(tmp_path / "landing")
    for rows in batches:
        captures(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        for start, name in ((write_quotes, "quotes"), (keep_latest, "latest")):
            stream = quote_stream(read_landing_stream(spark, landing, files_per_trigger=1))
            start(stream, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()


def files(tmp_path, name):
    return {p for p in glob.glob(str(tmp_path / name / "**" / "*.parquet"), recursive=True)}


def test_a_quote_that_comes_again_after_many_batches_appears_once(spark, tmp_path):
    first = [("http://a/", 1, 100), ("http://a/", 2, 110)]
    drained(spark, tmp_path, first, *[[(f"http://b{i}/", i, i)] for i in range(4)], first)
    rows = read_quotes(spark, str(tmp_path / "quotes")).where("url = 'http://a/'").collect()
    assert sorted((r["date"].second, r["redemption"], r["creation"]) for r in rows) == [(1, 100.0, 101.0), (2, 110.0, 111.0)]


def test_a_batch_rewrites_only_the_buckets_of_its_news(spark, tmp_path):
    many = [(f"http://f{i}/", 5, i) for i in range(200)]
    drained(spark, tmp_path, many)
    before = files(tmp_path, "latest")
    assert len(before) > 40
    drained(spark, tmp_path, many, [("http://f7/", 4, 1)])  # nothing newer
    assert files(tmp_path, "latest") == before
    drained(spark, tmp_path, [("http://f7/", 9, 70)])
    added = files(tmp_path, "latest") - before
    assert len(added) == 1 and before <= files(tmp_path, "latest")
    newest = {r["url"]: r["redemption"] for r in read_latest(spark, str(tmp_path / "latest")).collect()}
    assert newest == {f"http://f{i}/": float(i) for i in range(200)} | {"http://f7/": 70.0}


def test_old_versions_of_a_bucket_are_removed_and_its_number_is_fixed(spark, tmp_path):
    drained(spark, tmp_path, *[[("http://f/", i, i)] for i in range(5)])
    assert len(files(tmp_path, "latest")) == 3
    assert read_latest(spark, str(tmp_path / "latest")).first()["redemption"] == 4.0
    stream = quote_stream(read_landing_stream(spark, str(tmp_path / "landing")))
    with pytest.raises(Exception, match="another number of buckets"):
        keep_latest(stream, str(tmp_path / "latest"), str(tmp_path / "other"), buckets=8).awaitTermination()


def test_a_batch_that_runs_again_leaves_the_same_rows(spark, tmp_path):
    """The log of the last batch is lost, as when a driver ends between writing and noting it."""
    drained(spark, tmp_path, [("http://a/", 1, 1), ("http://b/", 1, 2)], [("http://a/", 2, 3)])
    for name in ("quotes", "latest"):
        for path in (tmp_path / f"{name}-state" / "commits").glob("*1*"):
            path.unlink()
    before = [sorted(map(str, read(spark, str(tmp_path / n)).collect())) for read, n in ((read_quotes, "quotes"), (read_latest, "latest"))]
    drained(spark, tmp_path, [("http://c/", 1, 9)])
    after = [sorted(map(str, read(spark, str(tmp_path / n)).collect())) for read, n in ((read_quotes, "quotes"), (read_latest, "latest"))]
    assert all(set(b) < set(a) and len(a) == len(b) + 1 for b, a in zip(before, after))


def test_polling_runs(spark):
    def poll(url, minute, ms, key="nextTimeInterval"):
        at = datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)
        return ("RayanHamafza2", url, "1", "live_navps", 1, 200, at, f'{{"{key}":{ms},"fundId":1}}' if ms else "{}")

    rows = [poll("a", 0, 600_000), poll("a", 9, 60_000), poll("a", 9.5, 0), poll("a", 20, -5), poll("b", 3, 120_000), poll("b", 4, 1)]
    found = quotes.polling_runs(quotes.polls(spark.createDataFrame(rows, RESPONSES)))
    minute = lambda t: (t - datetime.datetime(2024, 1, 1)).total_seconds() / 60
    got = sorted((r["url"], *[minute(r[c]) for c in ("first_poll", "last_poll", "expected")], r["polls"]) for r in found.collect())
    assert got == [("a", 0, 9.5, 10.5, 3), ("a", 20, 20, 21, 1), ("b", 3, 4, 5, 2)]
