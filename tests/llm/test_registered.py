import pytest

import __spark_entry__ as entry
from tessera.llm.queries import ORACLE_SQL, QUERIES

from ..oracle import check


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, small, name):
    check(spark, QUERIES, ORACLE_SQL, name, small)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
