"""Operators that SQL can express equal it on the smallest tables."""

import duckdb
import pytest

from millrace.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, found.fetchall()))
