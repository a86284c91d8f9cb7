"""Every registered query runs, and equals its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import compare, duck

QUERIES, TWINS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_registry():
    assert set(TWINS) <= set(QUERIES)
    assert len(QUERIES) > 70


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_twin(spark, con, sf, name):
    ok, note = compare(spark, con, name, QUERIES[name], TWINS.get(name), sf)
    assert ok, note
    assert "TYPES" not in note


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "date_key"
