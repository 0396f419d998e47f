"""Every registered query against its DuckDB statement (the driver's gate), on
the smallest data set; ``python tests/oracle_check.py`` runs it at sf0.01."""
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck
from trafficwatch.catalog import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, SF_SMALL, name, QUERIES[name], SQL.get(name), con)
    assert result["status"] in ("OK", "rows-only"), result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "violation_id" in df.columns
