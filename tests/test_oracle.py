"""Every registered query gives the rows of its SQL."""

import pytest

from catalog.queries import ORACLES, QUERIES
from tests.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_DIR) is None
