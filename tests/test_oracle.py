"""Every registered query against its DuckDB oracle on the smallest driver data."""

import pytest

import __spark_entry__ as entry
from ratingsmith.plans import catalog
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert info["ok"] in (True, None), info


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["genre", "rating_year", "avg_rating", "rating_count"]
    assert df.count() > 0
