"""Every query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workloads.check import differences, expected

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@needs_data
@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_matches_sql(spark, name):
    df = queries()[name](spark, FOLDER)
    problem = differences(df.columns, df.collect(), *expected(FOLDER, oracle_sql()[name]))
    assert problem is None, problem


@needs_data
def test_entry(spark):
    assert entry(spark).count() > 0


@needs_data
def test_streamed_quotes_equal_a_batch(spark):
    from fundlake.operators.quotes import live_quotes
    from workloads.encode import time_text
    from workloads.quotes import event_quotes
    from workloads.registry import Tables

    batch = live_quotes(event_quotes(Tables(spark, FOLDER)))
    wanted = batch.select("url", time_text("date").alias("quoted_at")).distinct()
    got = queries()["quote_stream"](spark, FOLDER)
    assert sorted(map(tuple, got.select("url", "quoted_at").collect())) == sorted(map(tuple, wanted.collect()))


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
