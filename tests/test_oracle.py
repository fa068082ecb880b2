"""Registered queries against their DuckDB SQL on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from mining_helpers import SF0001

QUERIES = sorted(E._QUERIES)  # the mining queries; the others have tests of their own


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("part", "lineitem", "orders", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF0001), reason="test tables not present")
@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["k", "itemset", "support"]
    assert df.count() == 184
