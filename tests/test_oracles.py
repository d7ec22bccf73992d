"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

from stratiform.queries import oracles, queries
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
SQL = oracles()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), con, SQL[name]) == []


def test_queries_without_sql_have_rows(spark):
    for name in sorted(set(queries()) - set(SQL)):
        assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
