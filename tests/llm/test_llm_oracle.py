"""Registered queries against their DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest
from helpers import SF

from basketry.llm import queries


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = queries.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(
        repr(tuple(r[i] for i in at)) for r in want.fetchall())
