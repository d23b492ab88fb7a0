import re

import pytest
from __spark_entry__ import oracle_sql, queries
from carrymark.llm.queries import ORACLES, QUERIES
from verification.compare import difference, open_tables

SMALL = "/root/testdata/sf0.001"


def test_each_operator_and_the_pipeline_are_registered():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(open_tables(SMALL), queries()[name](spark, SMALL), oracle_sql()[name]) is None
