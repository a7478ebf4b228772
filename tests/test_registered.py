"""Every registered query with SQL returns the SQL's rows on the smallest tables."""

from __future__ import annotations

import os

import pytest

from compare import difference, duck
from shelfcast.checks import ORACLES, QUERIES

TABLES = os.environ.get("SHELFCAST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(TABLES)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, TABLES) is None


def test_every_sql_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()
