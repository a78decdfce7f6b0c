"""Every registered query against its SQL on the smallest tables."""

import pytest

from registry.oracles import ORACLES
from registry.queries import QUERIES
from tests.compare import compare, duck


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, small, connection, name):
    assert compare(QUERIES[name](spark, small), connection, ORACLES[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    found = entry.entry(spark)
    assert found.columns == ["user_segment", "user_count", "percentage"]
    assert 0 < found.count() <= 4
