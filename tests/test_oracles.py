"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, oracle_connection

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return oracle_connection(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, folder, name):
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], folder) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_fitted_query_has_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
