"""Every catalogue query vs its DuckDB twin on the shared tables (sf0.001),
plus the driver contract."""

import os

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from oracle_check import compare, duck

from stratus.plans import catalog

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_catalogue_query_has_sql():
    """Queries without SQL come from the training-data subpackage only; its own tests
    name a brute-force test for each (tests/llm/test_covered.py)."""
    assert set(catalog.SQL) == set(catalog.QUERIES)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data absent")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["city_id", "city_name", "country", "date", "avg_temperature_2m",
                          "avg_relative_humidity_2m", "avg_wind_speed_10m"]
    assert df.count() > 0
