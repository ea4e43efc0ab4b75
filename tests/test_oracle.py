"""Every registered query against DuckDB on the same tables."""

import os

import pytest

import __spark_entry__ as entry_module
from ledgerlake.workload.oracle import ORACLE
from ledgerlake.workload.queries import QUERIES

import compare
from conftest import DATA

SF = os.path.join(DATA, os.environ.get("LEDGERLAKE_SF", "sf0.001"))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert compare.difference(df, duck, ORACLE[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
