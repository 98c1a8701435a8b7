"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as bound
import check
from conftest import SF

QUERIES, ORACLES = bound.queries(), bound.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert check.compare(con, ORACLES[name], QUERIES[name](spark, SF)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert bound.entry(spark).count() > 0
