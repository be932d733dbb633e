"""Registered queries against the SQL oracle."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import database, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, db, key):
    count, different = differences(QUERIES[key](spark, SF_DIR), db, ORACLE[key])
    assert not different
    assert count


def test_entry(spark):
    assert entry.entry(spark).columns == ["skill", "job_count"]
