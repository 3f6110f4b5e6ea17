"""Every registered query against its SQL twin, over the smallest test tables."""

import pytest

import __spark_entry__ as contract
import compare

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in contract.queries().items() if name not in contract.LLM_QUERIES}
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name not in contract.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare.difference(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) is None
