"""Every registered query against its SQL, on the smallest tables."""

import pytest

from marketlake.registry import ORACLES, QUERIES
from verify import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
