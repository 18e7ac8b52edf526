"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from oracle import compare, connect

from ctrflow.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    sql = catalog.ORACLES.get(name)
    result, rows, _, _ = compare(spark, con, name, catalog.QUERIES[name], sql, SF)
    assert result == ("ok" if sql else "rows"), result
    assert rows > 0 or sql


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0
