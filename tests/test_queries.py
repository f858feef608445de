"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import pytest

from check_oracles import compare, connect
from siteplan.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert not compare(spark, SF, name, con).startswith("BAD")
