"""Every registered query against its SQL on the given tables."""

import os

import pytest

from checks import QUERIES, SQL
from checks.compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    diff, _ = difference(spark, con, name, SF)
    assert diff is None
