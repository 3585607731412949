"""Every named query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, con, name):
    assert differences(spark, sf, con, name, QUERIES[name], ORACLE[name]) == []


def test_entry_and_names(spark):
    assert set(ORACLE) <= set(QUERIES)
    assert entry.entry(spark).count() > 0
