import pytest
from oracle import connect, spark_rows, sql_rows

from sievework.llm import queries


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name, sf):
    assert spark_rows(queries.QUERIES[name](spark, sf)) == sql_rows(connect(sf), queries.ORACLE_SQL[name])


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in entry.queries())] == []
    assert "pipeline" in entry.queries()
