"""Every registered query against its DuckDB SQL at sf0.01 (rows, names, values)."""

import pytest

import __spark_entry__ as entry
from tallyframe.plans import oracle, registry
from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], SQL[name], SF_ORACLE)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["community", "unit_id", "unit", "unit_party", "unit_votes", "group_party",
                          "group_votes", "coincides", "population_share"]
