"""Every registered query against its SQL statement."""

import pytest

import __spark_entry__ as registry
import oracle_queries
from tests.compare import compare

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
# Queries of the optional corpus operators have tests of their own.
ORACLES = oracle_queries.oracle_sql()
QUERIES = {name: q for name, q in registry.queries().items() if q.__module__ == registry.__name__}


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, MEDIUM, QUERIES[name], ORACLES[name]) > 0


@pytest.mark.parametrize("name", ["parse_clf", "q1_daily_traffic", "q2_top_resources", "q3_hourly_errors"])
def test_small_scale(spark, name):
    assert compare(spark, SMALL, QUERIES[name], ORACLES[name]) > 0
