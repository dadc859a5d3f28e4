"""Every registered query against its SQL on the smallest of the given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_sql import compare, connect
from portcheck.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, con, name):
    verdict, n = compare(spark, con, name, SF_DIR)
    assert verdict == "ok" and n > 0


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert len(entry(spark).columns) == 37
