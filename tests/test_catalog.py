"""Every query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from fleethealth import catalog


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 5) + 0.0 if isinstance(v, float) else v


def table(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def test_each_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_agrees_with_sql(spark, small, duck, name):
    df = catalog.queries()[name](spark, small)
    cur = duck.execute(catalog.oracle_sql()[name])
    columns = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(columns)
    ours, theirs = table(df.columns, [tuple(r) for r in df.collect()]), table(columns, cur.fetchall())
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-5)), (a, b)
