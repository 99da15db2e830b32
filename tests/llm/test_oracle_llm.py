"""The queries of the subpackage against their SQL twins, and what has none."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import connect, difference  # noqa: E402

from galegrid.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_as_sql(spark, sf_dir, connection, name):
    assert difference(spark, connection, name, QUERIES[name], ORACLE[name], sf_dir) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
