"""Registered queries of this package against their SQL, and against each other's tables."""

import pytest

import __spark_entry__ as contract
from stratiform.llm.catalogue import ORACLES, QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
