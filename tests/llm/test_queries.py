from types import SimpleNamespace

import pytest

from obslake.llm import queries
from tests.oracle import compare, connect

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    query = SimpleNamespace(run=queries.QUERIES[name], sql=queries.SQL[name])
    verdict, _, _ = compare(spark, connect(DATA), query, DATA)
    assert verdict.startswith("ok"), verdict
