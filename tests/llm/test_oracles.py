"""Queries with SQL against DuckDB on the smallest driver tables; all queries have stable columns there."""

import os

import duckdb
import pytest

from playlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(repr, want))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
