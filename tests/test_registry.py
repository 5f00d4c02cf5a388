"""Every registered query against its SQL twin on the smallest data."""

import pytest

from workload.compare import connect, difference
from workload.registry import ALL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_matches_sql(spark, con, name):
    query, sql = ALL[name]
    assert sql is not None
    assert difference(query(spark, SF), con, sql) is None
