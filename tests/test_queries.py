import pytest

from tessera.plans.queries import ORACLE_SQL, QUERIES

from .oracle import check


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, name):
    check(spark, QUERIES, ORACLE_SQL, name, small)


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
