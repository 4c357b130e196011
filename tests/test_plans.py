"""Physical plans: what must not occur in them, and what must reach the scan."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from workloads.registry import QUERIES
from fundlake.operators import allocation, dividends, nav, quotes
from fundlake.sources.landing import read_responses, write_responses

# Queries that run a job while their plan is built.
WRITES = ("quote_stream", "latest_quote_stream", "catalog_roundtrip")
FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "InPandas"):
        assert bad not in text
    assert "SinglePartition" not in text or name in ("coverage_valid_count",)


@pytest.fixture(scope="module")
def landing(spark, land, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "responses")
    write_responses(
        land(
            ("TadbirPardaz", "http://a.ir/", "", "dividend_history", 1, "<tbody></tbody>"),
            ("RayanHamafza", "http://r.ir/", "1", "live_navps", 1, "{}"),
        ),
        path,
    )
    return read_responses(spark, path)


@pytest.mark.parametrize(
    "operator",
    [
        dividends.report_dividends,
        dividends.json_dividends,
        quotes.live_quotes,
        quotes.tadbir_quotes,
        nav.tadbir_navps,
        nav.rayan_navps,
        nav.mabna_navps,
        nav.nav_report,
        allocation.allocation,
        allocation.cash_ratio,
    ],
)
def test_parsing_needs_no_shuffle_and_filters_reach_the_scan(landing, operator):
    text = plan(operator(landing))
    assert "Exchange" not in text
    assert "PartitionFilters: [isnotnull(endpoint" in text
    # The cash scan reports failed responses instead of leaving them out.
    assert operator is allocation.cash_ratio or "GreaterThanOrEqual(status,200)" in text


def test_unused_columns_are_not_read(landing):
    text = plan(dividends.report_dividends(landing))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "body" in schema and "fetched_at" not in schema


def test_leveraged_history_shuffles_once(landing):
    assert plan(nav.leveraged_navps(landing)).count("Exchange hashpartitioning") == 1


def test_bodies_are_parsed_once(landing):
    """No filter below the generators repeats the parsing."""
    text = plan(nav.navps_history(landing))
    filters = [line for line in text.split("\n") if "Filter (" in line]
    assert not any("from_json" in line for line in filters)


def test_range_filter_does_not_repeat_the_parsing(landing):
    import datetime

    rows = dividends.report_dividends(landing, from_date=datetime.date(2024, 1, 1))
    filters = [line for line in plan(rows).split("\n") if "Filter " in line]
    assert not any("regexp_extract_all" in line for line in filters)
    assert rows.filter(F.lit(True)).count() == 0


@needs_data
def test_allocation_date_does_not_repeat_parsing(spark):
    text = QUERIES["allocation_long"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") <= 5
