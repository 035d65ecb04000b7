"""Every registered query equals its SQL over the same tables."""

import pytest
from compare import difference, duck
from conftest import SF

import __spark_entry__ as entry
from vantrail.plans import catalog

QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert name in ORACLE, "every query here can be said in SQL"
    assert difference(df, con, ORACLE[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "active_aircraft" in df.columns


def test_same_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
