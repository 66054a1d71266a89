"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "customer")


def connect():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value if value is None else repr(value) if isinstance(value, str) else repr(float(value))


def differences(query, sql, spark, connection):
    """(columns, rows only in Spark, rows only in DuckDB, Spark row count)."""
    result = query(spark, SF_DIR)
    names = sorted(result.columns)
    ours = Counter(tuple(_plain(r[n]) for n in names) for r in result.collect())
    relation = connection.sql(sql)
    theirs_names = relation.columns
    if sorted(theirs_names) != names:
        return (names, sorted(theirs_names)), None, None, 0
    order = [theirs_names.index(n) for n in names]
    theirs = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    return names, ours - theirs, theirs - ours, sum(ours.values())
