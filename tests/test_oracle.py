"""Every query with SQL gives what DuckDB gives; the others run."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import canon

CORE = [n for m in entry.MODULES if not m.__name__.startswith("longtide.llm") for n in m.QUERIES]


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(map(canon, r)) for r in df.select(*cols).collect())
    if sql := entry.oracle_sql().get(name):
        cur = db.execute(sql)
        have = [c[0] for c in cur.description]
        assert sorted(have) == cols
        assert got == sorted(tuple(canon(r[have.index(c)]) for c in cols) for r in cur.fetchall())
    else:
        assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
