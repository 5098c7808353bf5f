"""Every registered query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from matchloom.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_against_duckdb(spark, db, name):
    df = catalogue.queries()[name](spark, FOLDER)
    found = db.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in df.columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == want


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
