"""The registered queries with SQL give the rows that DuckDB gives, on the smallest tables."""

import os

import duckdb
import pytest

from matchloom.llm import queries

from ..test_queries import FOLDER, TABLES, plain

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries.queries()[name](spark, FOLDER)
    found = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in df.columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == want
