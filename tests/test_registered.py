"""Every registered query against its SQL oracle."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from carrymark.queries import all_queries
from carrymark.sources.sample_inputs import sample_catalog
from conftest import SMALL
from verification.compare import difference, open_tables

QUERIES = {name: query for name, query in queries().items() if name in all_queries()}
ORACLE = {name: text for name, text in oracle_sql().items() if name in all_queries()}


@pytest.fixture(scope="module")
def duck():
    return open_tables(SMALL)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_returns_the_fund_mart(spark):
    df = entry(spark)
    assert df.count() > 0
    assert {"fund_id", "period_end_date", "tvpi"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert difference(duck, QUERIES[name](spark, SMALL), ORACLE[name]) is None


def test_marts_from_facts_leave_the_catalog_as_it_was(spark):
    catalog = sample_catalog(spark, SMALL)
    for name in ("fund_performance_from_facts", "position_performance_from_facts"):
        all_queries()[name](catalog)
    assert not catalog.given
