"""Registered queries against their SQL, on whole tables."""

import pytest

from pulselake.llm.oracles import ORACLES
from pulselake.llm.queries import QUERIES
from tests.llm.compare import SF_DIR, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = connect().sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    names = sorted(ours.columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    left = sorted((tuple(plain(r[n]) for n in names) for r in ours.collect()), key=str)
    order = [theirs.columns.index(n) for n in names]
    right = sorted((tuple(plain(row[i]) for i in order) for row in theirs.fetchall()), key=str)
    assert left == right and left


def test_operators_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, len(QUERIES) + 1)]
