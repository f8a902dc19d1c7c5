"""Every query of the engine equals its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.catalogue import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([round(float(r[i]), 6) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name in ORACLE_SQL:
        found = con.execute(ORACLE_SQL[name])
        columns = [c[0] for c in found.description]
        assert canonical(df.columns, map(tuple, got)) == canonical(columns, found.fetchall())
    else:
        assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
