"""Queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(entry._own_sql()))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
