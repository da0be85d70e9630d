import pytest
from oracle_check import compare, database

import __spark_entry__ as entry
from ripplelog.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_registries_match():
    assert set(catalog.registered()) - set(oracle.oracle()) == set()
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.registered()))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10
