"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from galegrid.plans import oracle
from galegrid.plans.registry import QUERIES

TWINS = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(TWINS))
def test_same_as_sql(spark, sf_dir, connection, name):
    assert difference(spark, connection, name, QUERIES[name], TWINS[name], sf_dir) is None


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(TWINS) == {"count_model", "boosted_model"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.limit(1).count() == 1
    assert df.schema == entry.entry(spark).schema
