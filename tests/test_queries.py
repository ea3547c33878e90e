"""Every registered query against its SQL on the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from workload import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_only_the_inventory_has_no_sql():
    own = set(catalog.QUERIES)
    assert own - set(entry.oracle_sql()) == {"q_landing_inventory"}
    assert own <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.collect()
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
