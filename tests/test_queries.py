"""Every registered catalogue query against its SQL at the smallest scale."""

import pytest
from oracle import connect, spark_rows, sql_rows

from sievework.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    cols, rows = spark_rows(registry.QUERIES[name](spark, SF))
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    assert (cols, rows) == sql_rows(con, registry.ORACLE_SQL[name])


def test_every_sql_has_a_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries())
