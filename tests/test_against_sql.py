"""Every registered query gives the rows its SQL gives."""

import os

import pytest
from check import compare, duck

from driver_queries import ALL_QUERIES, ALL_SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(ALL_QUERIES))
def test_same_rows(spark, con, name):
    state, _, _, note = compare(spark, con, name, ALL_QUERIES[name], ALL_SQL.get(name), SF_DIR)
    assert state in ("ok", "rows-only"), note
