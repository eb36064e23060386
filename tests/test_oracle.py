"""Every registered query against its SQL, on the smallest benchmark tables."""

import pathlib

import pytest
from compare import connect, difference

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no benchmark tables")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # All but the training-text queries, whose results are checked against brute force in tests/llm.
    assert all(n == "pipeline" or n.startswith("op") for n in set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10
