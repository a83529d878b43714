"""Every named query against its SQL on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from lexstat.plans import queries as core

DATA = Path(os.environ.get("BENCH_DATA", "/root/testdata")) / "sf0.001"
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def plain(v):
    return "None" if v is None or isinstance(v, float) and math.isnan(v) else repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in DATA.iterdir():
        c.sql(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, con, name):
    df = core.queries()[name](spark, str(DATA))
    rows, cols = df.collect(), sorted(df.columns)
    sql = core.oracle_sql().get(name)
    if sql is None:
        assert cols
        return
    rel = con.sql(sql)
    have = rel.columns
    want = sorted(tuple(plain(r[have.index(c)]) for c in sorted(have)) for r in rel.fetchall())
    assert cols == sorted(have)
    assert sorted(tuple(plain(r[c]) for c in cols) for r in rows) == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["bucket", "n_keys"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
