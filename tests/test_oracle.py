"""Every registered query with a SQL twin gives the same rows in both engines."""

import pytest

from parity import compare, connect

from assetweave.oracle import ORACLE
from assetweave.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_twins_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    good, note = compare(spark, con, name, sf_dir)
    assert good, note


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= QUERIES.keys()
    assert entry.oracle_sql().keys() >= ORACLE.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
