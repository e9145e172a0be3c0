"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from pricewright.queries import registry

ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, duck, sf_dir, name):
    ok, note, _ = compare(spark, duck, name, entry.queries()[name], ORACLE.get(name), sf_dir)
    assert ok, note


def test_every_query_has_sql():
    assert set(registry.queries()) == set(ORACLE)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
