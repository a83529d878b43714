"""Queries of the subpackage against their SQL, on the small tables."""

from pathlib import Path

import duckdb
import pytest

from lexstat.llm import queries

DATA = Path("/root/testdata/sf0.001")


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for f in DATA.iterdir():
        con.sql(f"create view {f.stem} as select * from '{f}'")
    df = queries.queries()[name](spark, str(DATA))
    rel = con.sql(queries.oracle_sql()[name])
    have, cols = rel.columns, sorted(df.columns)
    assert cols == sorted(have)
    want = sorted((tuple(plain(r[have.index(c)]) for c in cols) for r in rel.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    assert got == want
