"""Every named query against its SQL counterpart in DuckDB; trained models by row count."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract
from check_oracle import compare, connect

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, con, name):
    assert compare(spark, con, folder, name, QUERIES[name], ORACLES.get(name)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
