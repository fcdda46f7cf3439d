"""Every registered query against its comparison SQL, and the driver's contract."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog_star.registry import QUERIES
from tools.compare import compare, connect

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, db, name):
    assert compare(spark, db, name, DATA) is None


def test_contract(spark):
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql()) <= set(queries())
    found = entry(spark)
    assert found.columns == ["track_genre", "winning_artists"] and found.count() > 0
