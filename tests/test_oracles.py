"""Every query of the lake against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import SF_DIR, connect, differences
from workload.oracles import oracles
from workload.queries import QUERIES

SQL = oracles()


@pytest.fixture(scope="module")
def duck():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, duck):
    names, only_spark, only_sql, count = differences(QUERIES[name], SQL[name], spark, duck)
    assert only_spark is not None, f"columns differ: {names}"
    assert not only_spark and not only_sql
    assert count > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(name, spark):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert len(entry_points.entry(spark).columns) == 36
