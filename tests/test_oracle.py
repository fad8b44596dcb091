"""Every registered query that SQL can express against its SQL on the smallest data set, jobs included."""

import pytest

from obslake.registry import QUERIES
from tests.oracle import DATA, compare, connect

SF = f"{DATA}/sf0.001"
NAMES = [n for n, q in QUERIES.items() if q.sql]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, QUERIES[name], SF)
    assert verdict.startswith("ok"), verdict
