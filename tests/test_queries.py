"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import pytest
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
from compare import compare, duck  # noqa: E402

from freshet.catalog import QUERIES, SQL  # noqa: E402


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, SF, name) == ""
