"""Every registered query against DuckDB on the test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from check import compare, connect
from clickloom.plans.oracle import ORACLE
from clickloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    same, note = compare(
        entry_points.queries()[name](spark, FOLDER), db, entry_points.oracle_sql()[name]
    )
    assert same, note


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
